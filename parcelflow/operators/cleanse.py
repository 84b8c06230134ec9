"""Imputation, masking and the shape of a cleaned table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from parcelflow.model import INGEST_COLUMNS, Contract, Mask


def impute(df: DataFrame, values: dict[str, float], flag: bool = True) -> DataFrame:
    """Replace nulls; with ``flag``, ``<column>_missing`` tells where a value was put in."""
    if flag:
        df = df.withColumns({f"{c}_missing": F.col(c).isNull() for c in values})
    return df.fillna(values) if values else df


def mask(df: DataFrame, masks: Iterable[Mask]) -> DataFrame:
    """Replace clear text by its SHA-256; the clear column is dropped."""
    masks = list(masks)
    hashed = {
        m.output: F.sha2(F.coalesce(F.col(m.column), F.lit("")) if m.mandatory else F.col(m.column), 256)
        for m in masks
    }
    return df.withColumns(hashed).drop(*[m.column for m in masks]) if masks else df


def finish(df: DataFrame, contract: Contract) -> DataFrame:
    """Imputed and masked columns in place of the source ones; other columns stay."""
    df = impute(df, contract.imputed)
    df = impute(df, contract.filled, flag=False)
    return mask(df, contract.masks)


def clean_columns(df: DataFrame, contract: Contract) -> list[str]:
    return contract.clean_columns + [c for c in INGEST_COLUMNS if c in df.columns]
