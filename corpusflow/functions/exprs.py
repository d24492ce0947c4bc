"""Python-like row expressions compiled once into a Spark Column.

The expression text is parsed by Python's own ``ast`` module and turned into
a Column tree against the frame's schema, so it runs JVM-side and is
constant-folded by Catalyst instead of being re-evaluated per row.  Names are
row fields (an ``entry.`` prefix is removed).  Of a chained comparison only the
first comparator is used, as in the rule.  ``and``, ``or``, ``not`` and the test of
``if`` take any value: zero, empty and null are false, and ``and`` / ``or`` give one
of their operands.
"""

from __future__ import annotations

import ast
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Typed:
    __slots__ = ("col", "dtype", "exponent")

    def __init__(self, col: Column, dtype, exponent=None):
        self.col = col
        self.dtype = dtype
        self.exponent = exponent          # the value of an integer constant


def _lit_type(v):
    if isinstance(v, bool):
        return T.BooleanType()
    if isinstance(v, int):
        return T.LongType()
    if isinstance(v, float):
        return T.DoubleType()
    if isinstance(v, str):
        return T.StringType()
    if v is None:
        return T.NullType()
    return None


def _num(t) -> bool:
    return isinstance(t, T.NumericType)


def _bin(op, a: _Typed, b: _Typed) -> _Typed:
    x, y = a.col, b.col
    if isinstance(op, ast.Add):
        if isinstance(a.dtype, T.StringType) or isinstance(b.dtype, T.StringType):
            return _Typed(F.concat(x, y), T.StringType())
        if isinstance(a.dtype, T.ArrayType):
            return _Typed(F.concat(x, y), a.dtype)
        return _Typed(x + y, _wider(a.dtype, b.dtype))
    if isinstance(op, ast.Sub):
        return _Typed(x - y, _wider(a.dtype, b.dtype))
    if isinstance(op, ast.Mult):
        if isinstance(a.dtype, T.StringType):
            return _Typed(F.repeat(x, y.cast("int")), T.StringType())
        return _Typed(x * y, _wider(a.dtype, b.dtype))
    if isinstance(op, ast.Div):
        return _Typed(x.cast("double") / y.cast("double"), T.DoubleType())
    if isinstance(op, ast.FloorDiv):
        t = _wider(a.dtype, b.dtype)
        if isinstance(t, T.IntegralType):
            return _Typed(_floor_div(x.cast("long"), y.cast("long")), T.LongType())
        return _Typed(F.floor(x.cast("double") / y.cast("double")).cast("double"), t)
    if isinstance(op, ast.Mod):
        # Python: the result takes the divisor's sign
        t = _wider(a.dtype, b.dtype)
        if isinstance(t, T.IntegralType):
            x, y = x.cast("long"), y.cast("long")
            return _Typed(x - y * _floor_div(x, y), T.LongType())
        return _Typed(x - y * F.floor(x.cast("double") / y.cast("double")), t)
    if isinstance(op, ast.Pow):
        if isinstance(_wider(a.dtype, b.dtype), T.IntegralType) and isinstance(b.exponent, int) and b.exponent >= 0:
            return _Typed(F.aggregate(F.array_repeat(x.cast("long"), b.exponent), F.lit(1).cast("long"), lambda acc, v: acc * v), T.LongType())
        return _Typed(F.pow(x, y), T.DoubleType())
    if isinstance(op, ast.BitOr):
        return _Typed(x | y, T.BooleanType()) if _bool(a, b) else _Typed(x.bitwiseOR(y), a.dtype)
    if isinstance(op, ast.BitAnd):
        return _Typed(x & y, T.BooleanType()) if _bool(a, b) else _Typed(x.bitwiseAND(y), a.dtype)
    if isinstance(op, ast.BitXor):
        return _Typed(x != y, T.BooleanType()) if _bool(a, b) else _Typed(x.bitwiseXOR(y), a.dtype)
    if isinstance(op, ast.LShift):
        return _Typed(F.shiftleft(x, y), a.dtype)
    if isinstance(op, ast.RShift):
        return _Typed(F.shiftright(x, y), a.dtype)
    raise ValueError(f"unsupported operator {type(op).__name__}")


def _floor_div(x: Column, y: Column) -> Column:
    """Exact floor division of longs (``div`` cuts towards zero)."""
    q = F.call_function("div", x, y)
    return F.when((x - q * y != 0) & ((x < 0) != (y < 0)), q - 1).otherwise(q)


def _truth(v: _Typed) -> Column:
    """Python's truth of a value."""
    if isinstance(v.dtype, T.BooleanType):
        return F.coalesce(v.col, F.lit(False))
    if isinstance(v.dtype, T.StringType):
        return F.coalesce(F.length(v.col) > 0, F.lit(False))
    if isinstance(v.dtype, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(v.col) > 0, F.lit(False))
    if isinstance(v.dtype, T.NumericType):
        return F.coalesce(v.col != 0, F.lit(False))
    return v.col.isNotNull()


def _bool(a, b) -> bool:
    return isinstance(a.dtype, T.BooleanType) and isinstance(b.dtype, T.BooleanType)


def _wider(a, b):
    if isinstance(a, T.DoubleType) or isinstance(b, T.DoubleType) or isinstance(a, T.FloatType) \
            or isinstance(b, T.FloatType):
        return T.DoubleType()
    if _num(a):
        return a if not _num(b) else (T.LongType() if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)
                                      else T.DoubleType())
    return b


_CMP = {ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b, ast.Lt: lambda a, b: a < b,
        ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b}


class _Compiler:
    def __init__(self, schema: T.StructType):
        self.fields = {f.name: f.dataType for f in schema.fields}

    def go(self, node) -> _Typed:
        m = getattr(self, "_" + type(node).__name__, None)
        if m is None:
            raise ValueError(f"unsupported syntax: {type(node).__name__}")
        return m(node)

    def _Expression(self, n):
        return self.go(n.body)

    def _BinOp(self, n):
        return _bin(n.op, self.go(n.left), self.go(n.right))

    def _UnaryOp(self, n):
        v = self.go(n.operand)
        if isinstance(n.op, ast.USub):
            return _Typed(-v.col, v.dtype)
        if isinstance(n.op, ast.UAdd):
            return v
        if isinstance(n.op, ast.Not):
            return _Typed(~_truth(v), T.BooleanType())
        if isinstance(n.op, ast.Invert):
            return _Typed(F.bitwise_not(v.col), v.dtype)
        raise ValueError("unsupported unary operator")

    def _Compare(self, n):
        a, b, op = self.go(n.left), self.go(n.comparators[0]), n.ops[0]
        if isinstance(op, (ast.Is, ast.IsNot)):
            if isinstance(n.comparators[0], ast.Constant) and n.comparators[0].value is None:
                c = a.col.isNull()
            else:
                c = a.col.eqNullSafe(b.col)
            return _Typed(c if isinstance(op, ast.Is) else ~c, T.BooleanType())
        if type(op) not in _CMP:
            raise ValueError(f"unsupported comparison {type(op).__name__}")
        return _Typed(_CMP[type(op)](a.col, b.col), T.BooleanType())

    def _BoolOp(self, n):
        vals = [self.go(v) for v in n.values]
        if all(isinstance(v.dtype, T.BooleanType) for v in vals):
            return _Typed(reduce((lambda a, b: a & b) if isinstance(n.op, ast.And) else (lambda a, b: a | b), [v.col for v in vals]), T.BooleanType())
        out = vals[-1]
        for v in reversed(vals[:-1]):
            first, rest = (out.col, v.col) if isinstance(n.op, ast.And) else (v.col, out.col)
            out = _Typed(F.when(_truth(v), first).otherwise(rest), v.dtype if v.dtype == out.dtype else _wider(v.dtype, out.dtype))
        return out

    def _IfExp(self, n):
        body, other = self.go(n.body), self.go(n.orelse)
        return _Typed(F.when(_truth(self.go(n.test)), body.col).otherwise(other.col), body.dtype)

    def _Constant(self, n):
        return _Typed(F.lit(n.value), _lit_type(n.value), n.value if type(n.value) is int else None)

    def _Name(self, n):
        if n.id in self.fields:
            return _Typed(F.col(n.id), self.fields[n.id])
        if n.id in ("True", "False"):
            return _Typed(F.lit(n.id == "True"), T.BooleanType())
        raise ValueError(f"unknown field {n.id!r}")

    def _Attribute(self, n):
        base = self.go(n.value)
        if isinstance(base.dtype, T.StructType):
            sub = {f.name: f.dataType for f in base.dtype.fields}
            return _Typed(base.col[n.attr], sub.get(n.attr))
        raise ValueError(f"attribute {n.attr!r} of a non-struct")

    def _List(self, n):
        items = [self.go(e) for e in n.elts]
        return _Typed(F.array(*[i.col for i in items]), T.ArrayType(items[0].dtype if items else T.NullType()))

    def _Dict(self, n):
        kv = []
        for k, v in zip(n.keys, n.values):
            kv += [self.go(k).col, self.go(v).col]
        return _Typed(F.create_map(*kv), T.MapType(T.StringType(), T.StringType()))

    def _Subscript(self, n):
        base = self.go(n.value)
        is_str = isinstance(base.dtype, T.StringType)
        length = F.length(base.col) if is_str else F.size(base.col)
        if isinstance(n.slice, ast.Slice):
            step = ast.literal_eval(n.slice.step) if n.slice.step is not None else 1
            if not isinstance(step, int) or step == 0:
                raise ValueError("a slice step has to be an integer other than 0")
            lo = self.go(n.slice.lower).col if n.slice.lower is not None else None
            hi = self.go(n.slice.upper).col if n.slice.upper is not None else None
            first, last = (F.lit(0), length) if step > 0 else (F.lit(-1), length - 1)

            def norm(i, default):
                if i is None:
                    return default
                return F.least(F.greatest(F.when(i < 0, i + length).otherwise(i), first), last)
            s = norm(lo, first if step > 0 else last)
            e = norm(hi, last if step > 0 else first)
            if step == 1:
                cnt = F.greatest(e - s, F.lit(0))
                if is_str:
                    return _Typed(F.call_function("substring", base.col, s + 1, cnt), base.dtype)
                return _Typed(F.slice(base.col, s + 1, cnt), base.dtype)
            # every step-th place from s on, up to but without e
            n_items = F.greatest(F.ceil((e - s) / step), F.lit(0)).cast("int")
            at = F.transform(F.slice(F.sequence(F.lit(0), F.greatest(n_items, F.lit(1))), F.lit(1), n_items), lambda k: (s + k * step + 1).cast("int"))
            if is_str:
                return _Typed(F.array_join(F.transform(at, lambda i: F.call_function("substring", base.col, i, F.lit(1))), ""), base.dtype)
            return _Typed(F.transform(at, lambda i: F.element_at(base.col, i)), base.dtype)
        key = self.go(n.slice)
        if isinstance(base.dtype, T.MapType):
            return _Typed(base.col[key.col], base.dtype.valueType)
        if isinstance(base.dtype, T.StructType):
            return _Typed(base.col[n.slice.value], None)
        idx = F.when(key.col < 0, key.col + length).otherwise(key.col) + 1
        if is_str:
            return _Typed(F.call_function("substring", base.col, idx, F.lit(1)), T.StringType())
        return _Typed(F.element_at(base.col, idx.cast("int")), base.dtype.elementType)

    def _Call(self, n):
        name = n.func.id if isinstance(n.func, ast.Name) else None
        args = [self.go(a) for a in n.args]
        if name == "len":
            a = args[0]
            return _Typed(F.length(a.col) if isinstance(a.dtype, T.StringType) else F.size(a.col), T.LongType())
        if name in ("max", "min"):
            if len(args) == 1:
                f = F.array_max if name == "max" else F.array_min
                return _Typed(f(args[0].col), getattr(args[0].dtype, "elementType", None))
            f = F.greatest if name == "max" else F.least
            return _Typed(f(*[a.col for a in args]), _wider(args[0].dtype, args[1].dtype))
        if name == "sum":
            a = args[0]
            return _Typed(F.aggregate(a.col, F.lit(0).cast(a.dtype.elementType), lambda acc, x: acc + x),
                          a.dtype.elementType)
        if name == "abs":
            return _Typed(F.abs(args[0].col), args[0].dtype)
        if name == "sorted":
            return _Typed(F.array_sort(args[0].col), args[0].dtype)
        raise ValueError(f"function {name!r} is not allowed")


def expr_to_column(expression: str, schema: T.StructType, var_prefix: str | None = "entry") -> Column:
    if var_prefix:
        expression = re.sub(rf"{re.escape(var_prefix)}\.(\w+)", r"\1", expression)
    tree = ast.parse(expression, mode="eval")
    return _Compiler(schema).go(tree).col


def lambda_expression(df: DataFrame, new_field: str, expression: str, filter: bool = False,
                      lambda_param_name: str = "entry") -> DataFrame:
    """P10: add ``new_field``; with ``filter=True`` keep rows where the value
    is exactly True (the column is still added)."""
    c = expr_to_column(expression, df.schema, lambda_param_name)
    out = df.withColumn(new_field, c)
    return out.filter(F.col(new_field).eqNullSafe(F.lit(True))) if filter else out
