"""Column masking by caller-supplied role: a convenience for shared views, not a security boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Who sees e-mail addresses, and what everybody else sees.
UNMASKED_ROLES = ("DATA_ENGINEER", "ACCOUNTADMIN")
MASK = "***MASKED***"


def mask_email(value: Column, role: str | Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.when(role.isin(*UNMASKED_ROLES), value).otherwise(F.lit(MASK))


def masked_view(dim: DataFrame, role: str) -> DataFrame:
    return dim.withColumn("email", mask_email(F.col("email"), role))
