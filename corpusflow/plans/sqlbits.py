"""SQL fragments for the DuckDB oracles (RE2 syntax, valid for Java too)."""

from corpusflow.functions.text import PY_WS_CLASS

WS = PY_WS_CLASS


def norm(x: str) -> str:
    """``' '.join(x.split())`` in DuckDB."""
    return f"regexp_replace(regexp_replace({x}, '{WS}+', ' ', 'g'), '^ | $', '', 'g')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def n_words(x: str) -> str:
    n = norm(x)
    return f"(CASE WHEN {n} = '' THEN 0 ELSE len(string_split({n}, ' ')) END)"


def words(x: str) -> str:
    n = norm(x)
    return f"(CASE WHEN {n} = '' THEN []::VARCHAR[] ELSE string_split({n}, ' ') END)"


def doc_manifest() -> str:
    from corpusflow.sources.manifest import DOC_DURATION_SQL
    return (f"SELECT 'doc/' || CAST(doc_id AS VARCHAR) || '.wav' AS audio_filepath, doc_id, text, lang, source, "
            f"{DOC_DURATION_SQL} AS duration FROM documents")
