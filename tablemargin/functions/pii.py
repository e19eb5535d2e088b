"""Salted hashing of personal fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def salted_hash(c: Column | str, salt: Column | str) -> Column:
    """SHA-256 hex of salt followed by the value; NULL stays NULL, so null gates keep meaning.

    A string `salt` is the salt itself; pass a Column for a salt held in the data.
    """
    value = F.col(c) if isinstance(c, str) else c
    prefix = F.lit(salt) if isinstance(salt, str) else salt
    return F.sha2(F.concat(prefix, value), 256)


def salted_hash_by_tenant(
    df: DataFrame, salts: DataFrame, columns: list[str], tenant: str = "merchant_id"
) -> tuple[DataFrame, DataFrame]:
    """Hash `columns` with each tenant's own salt.

    `salts` has a row per tenant (`tenant`, `pii_salt`); of several salts of a tenant the smallest
    counts, so that no row is doubled, and `check_salts` reports them.  Returns (hashed, rejects):
    rows of a tenant without a salt are rejected rather than hashed unsalted.
    """
    joined = df.join(salts.groupBy(tenant).agg(F.min("pii_salt").alias("pii_salt")), tenant, "left")
    hashed = joined.where(F.col("pii_salt").isNotNull())
    for name in columns:
        hashed = hashed.withColumn(f"{name}_salted", salted_hash(name, F.col("pii_salt")))
    return hashed.drop("pii_salt"), joined.where(F.col("pii_salt").isNull()).drop("pii_salt")


def fill_missing_salts(salts: DataFrame) -> DataFrame:
    """Give every tenant without a salt a random one of 32 hex characters.

    Random: write the result once and read it back; never recompute it.
    """
    fresh = F.replace(F.uuid(), F.lit("-"), F.lit(""))
    return salts.withColumn("pii_salt", F.coalesce("pii_salt", fresh))
