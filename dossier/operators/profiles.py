"""Applications, applicant profiles and documents: joins and lookups.

Joins are plain equi-joins on the key; with AQE on, Spark picks a broadcast
hash join only when runtime statistics show a side is small (a checked size),
otherwise a sort-merge join, and splits a skewed key (one applicant with a
large share of applications) with its skew-join handling. No join is hinted
to broadcast, because neither side has a size bound of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cipher import dealt, parse_birth_date, xor_decrypt

# Fixed value: shown when a profile field is not available.
NOT_AVAILABLE = "N/A"


def candidate_name(first="first_name", last="last_name") -> F.Column:
    """``first last``; a missing part is skipped (not printed as None)."""
    return F.concat_ws(" ", F.col(first), F.col(last))


def decrypt_names(df: DataFrame, key: str | None) -> DataFrame:
    """Decrypt the two name columns when a key is given."""
    if not key:
        return df
    return (dealt(df).withColumn("first_name", xor_decrypt("first_name", key))
                     .withColumn("last_name", xor_decrypt("last_name", key)))


def application_profiles(apps: DataFrame, profiles: DataFrame, key: str | None = None) -> DataFrame:
    """Applications joined to profiles on applicant_id (orphan
    applications drop out), names decrypted when ``key`` is given."""
    a = apps.select("detail_id", "applicant_id", "application_role", "cv_path")
    p = decrypt_names(profiles.select("applicant_id", "first_name", "last_name"), key)
    return (a.join(p, "applicant_id", "inner")
             .select("detail_id", "applicant_id", "application_role", "cv_path",
                     "first_name", "last_name", candidate_name().alias("name")))


def has_path():
    """A non-null, non-empty path."""
    return F.col("cv_path").isNotNull() & (F.col("cv_path") != "")


def existing_applications(apps: DataFrame, profiles: DataFrame, docs: DataFrame,
                          key: str | None = None) -> DataFrame:
    """Joined applications whose CV path exists among ``docs``."""
    return (application_profiles(apps.filter(has_path()), profiles, key)
            .join(docs.select("cv_path"), "cv_path", "left_semi"))


def profile_lookup(profiles: DataFrame, key: str | None = None,
                   applicant_id: int | None = None) -> DataFrame:
    """Profiles (optionally one applicant -- a pushed-down filter),
    decrypted when ``key`` is given, with ``date_of_birth`` parsed into a
    date and the unparseable text kept in ``date_of_birth_raw``."""
    p = profiles.select("applicant_id", "first_name", "last_name", "date_of_birth",
                        "address", "phone_number")
    if applicant_id is not None:
        p = p.filter(F.col("applicant_id") == F.lit(applicant_id))
    cols = ["first_name", "last_name", "date_of_birth", "address", "phone_number"]
    if key:
        p = p if applicant_id is not None else dealt(p)
        p = p.select("applicant_id", *[xor_decrypt(c, key).alias(c) for c in cols])
    else:
        p = p.withColumn("date_of_birth", F.col("date_of_birth").cast("string"))
    d, raw = parse_birth_date("date_of_birth")
    return p.select("applicant_id", "first_name", "last_name", d.alias("date_of_birth"),
                    raw.alias("date_of_birth_raw"), "address", "phone_number")


def biodata(lookup: DataFrame) -> DataFrame:
    """J5 right side: the profile fields shown in a summary."""
    return lookup.select(
        "applicant_id", F.lit(True).alias("_found"),
        F.col("first_name").alias("_first"), F.col("last_name").alias("_last"),
        F.coalesce(F.col("date_of_birth").cast("string"), F.col("date_of_birth_raw")).alias("_birthdate"),
        F.col("address").alias("_address"), F.col("phone_number").alias("_phone"),
    )


def attach_biodata(df: DataFrame, lookup: DataFrame, require_profile: bool = False) -> DataFrame:
    """Join the profile on applicant_id (left, or inner with
    ``require_profile``) and add ``name``, ``birthdate``, ``address`` and
    ``phone``. Birthdate is ``N/A`` unless present; address and phone are
    ``N/A`` when there is no profile (a profile with an empty field keeps the
    null)."""
    b = biodata(lookup)
    na = F.lit(NOT_AVAILABLE)
    found = F.col("_found").isNotNull()
    return (df.join(b, "applicant_id", "inner" if require_profile else "left")
              .withColumn("name", candidate_name("_first", "_last"))
              .withColumn("birthdate", F.coalesce("_birthdate", na))
              .withColumn("address", F.when(found, F.col("_address")).otherwise(na))
              .withColumn("phone", F.when(found, F.col("_phone")).otherwise(na))
              .drop("_found", "_first", "_last", "_birthdate", "_address", "_phone"))
