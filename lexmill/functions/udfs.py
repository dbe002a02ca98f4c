"""Vectorised Python UDFs around the plain functions; made when called, so that workers can import this module."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions import plain


def alias_text_udf(alias: Column, canonical: Column) -> Column:
    """[FN-13]"""

    def run(a: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else plain.alias_text(x, y) for x, y in zip(a, c)])

    return F.pandas_udf(run, "string")(alias, canonical)


def atomic_aliases_udf(alias: Column, canonical: Column) -> Column:
    """[CJ-08]"""

    def run(a: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else plain.atomic_aliases(x, y) for x, y in zip(a, c)], dtype="object")

    return F.pandas_udf(run, "array<string>")(alias, canonical)


def clean_aliases_udf(aliases: Column, canonical: Column) -> Column:
    """[CJ-09]"""

    def run(a: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([None if y is None else plain.clean_aliases(x, y) for x, y in zip(a, c)])

    return F.pandas_udf(run, "array<string>")(aliases, canonical)


def lenient_json_udf(text: Column) -> Column:
    """[FN-37] As JSON text; null where there is none."""

    def run(t: pd.Series) -> pd.Series:
        return pd.Series([None if (v := plain.lenient_json(x)) is None else json.dumps(v, sort_keys=True) for x in t], dtype="object")

    return F.pandas_udf(run, "string")(text)


def primary_type_udf(payload: Column) -> Column:
    """[FN-31]"""

    def run(p: pd.Series) -> pd.Series:
        return pd.Series([plain.primary_type(plain.lenient_json(x)) for x in p], dtype="object")

    return F.pandas_udf(run, "string")(payload)


def functional_roles_udf(payload: Column) -> Column:
    """[FN-36]"""

    def run(p: pd.Series) -> pd.Series:
        return pd.Series([plain.functional_roles(plain.lenient_json(x)) for x in p], dtype="object")

    return F.pandas_udf(run, "array<string>")(payload)


def lenient_rows_udf(text: Column) -> Column:
    """[FN-38] Each row as JSON text."""

    def run(t: pd.Series) -> pd.Series:
        return pd.Series([[json.dumps(r, sort_keys=True) for r in plain.lenient_rows(x)] for x in t], dtype="object")

    return F.pandas_udf(run, "array<string>")(text)


def alias_answer_udf(text: Column) -> Column:
    """[FN-39] The alias that the first answer names, null where it names none."""

    def run(t: pd.Series) -> pd.Series:
        return pd.Series([(plain.alias_answer(x) or {}).get("alias_of") for x in t], dtype="object")

    return F.pandas_udf(run, "string")(text)
