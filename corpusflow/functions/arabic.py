"""Arabic clean-up switches (T10), in a fixed order of steps."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIACRITICS = "".join(c for c in map(chr, range(0x0600, 0x06FF)) if unicodedata.category(c) == "Mn")
# Fixed values
PUNCTUATION = "?!:;-.,؟،؛"
TATWEEL = "ـ"
LAM, ALEF, HEH, TEH_MARBUTA = "ل", "ا", "ه", "ة"
LAM_ALEF_LIGATURES = "ﻻﻷﻹﻵ"
ALEF_FORMS = "آأإ"


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def clean_arabic(text: Column, remove_extra_spaces: bool = True, remove_empty_lines: bool = True, remove_diacritics: bool = False,
                 remove_punctuation: bool = False, remove_tatweel: bool = False, normalize_ligature: bool = False,
                 apply_nfkc: bool = False, normalize: bool = False) -> Column:
    """Steps in order: spaces, empty lines, diacritics, tatweel, punctuation,
    ligatures, letter forms (``normalize``: diacritics, alef, ligatures, teh), NFKC."""
    def ligatures(t: Column) -> Column:
        return F.regexp_replace(t, f"[{LAM_ALEF_LIGATURES}]", LAM + ALEF)

    t = text
    if remove_extra_spaces:
        t = F.regexp_replace(t, " +", " ")
    if remove_empty_lines:
        t = F.regexp_replace(F.regexp_replace(t, "\n+", "\n"), r"^\n|\n\z", "")
    if remove_diacritics:
        t = F.translate(t, DIACRITICS, "")
    if remove_tatweel:
        t = F.translate(t, TATWEEL, "")
    if remove_punctuation:
        t = F.translate(t, PUNCTUATION, "")
    if normalize_ligature:
        t = ligatures(t)
    if normalize:
        t = F.translate(ligatures(F.translate(F.translate(t, DIACRITICS, ""), ALEF_FORMS, ALEF * 3)), TEH_MARBUTA, HEH)
    return _nfkc(t) if apply_nfkc else t
