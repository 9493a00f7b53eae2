"""Raw person rows with their normalized values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, street, text
from ..plans.profiles import PROFILES, Profile

DOB, DOBS, SSN = "full_date_of_birth", "dobs", "social_security_number"


def normalized(df: DataFrame, profile: Profile = PROFILES["vf3"], idx: str = "rec_id") -> DataFrame:
    """``df`` with idx, first, last, mid, suf, ssn, ssn_full, dob_primary, dob, dob_raw and one token array per ID cell.

    ``idx`` orders the rows.  The date of birth is the first cell's, else the alternate cell's, as is what is shown of it.
    """
    df = df.withColumn("idx", F.col(idx).cast("long"))
    df = text.with_names(df, first="first_name", last="last_name", mid="middle_name", suf="suffix")
    df = df.withColumn("ssn", text.norm_ssn(SSN)).withColumn("ssn_full", text.ssn_full("ssn"))
    df = dates.with_dob(df, DOB, "dob_primary", profile.dob_floor)
    if profile.dob_alt and DOBS in df.columns:
        df = dates.with_dob(df, DOBS, "dob_alt", profile.dob_floor)
        first = F.col("dob_primary") != ""
        df = df.withColumn("dob", F.when(first, F.col("dob_primary")).otherwise(F.col("dob_alt")))
        df = df.withColumn("dob_raw", F.when(first, F.col(DOB)).otherwise(F.col(DOBS)))
    else:
        df = df.withColumn("dob", F.col("dob_primary")).withColumn("dob_raw", F.col(DOB))
    return df.withColumns({f"ids{level}": text.id_tokens(c) for level, c in profile.id_levels})


def with_address_key(df: DataFrame) -> DataFrame:
    """``df`` with the six normalized address fields a0..a5 and the street's base and unit."""
    df = street.with_street(df, "residential_address", "a0", "a_base", "a_unit")
    rest = {"a1": "city", "a2": "state_of_residence", "a3": "province_of_residence", "a5": "country_of_residence"}
    return df.withColumns({k: text.norm_text(c) for k, c in rest.items()} | {"a4": street.zip_key("zip_code")})


def known(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("first") != "") & (F.col("last") != ""))


def unknown(rows: DataFrame) -> DataFrame:
    """Rows without first or last name: raw cells, '[Unknown]' for what is missing, and which it is."""
    lost = [("first_name", "first", "First Name"), ("last_name", "last", "Last Name")]
    rows = rows.where((F.col("first") == "") | (F.col("last") == ""))
    field = F.concat_ws(" & ", *[F.when(F.col(n) == "", F.lit(label)) for _, n, label in lost])
    return rows.withColumn("unknown_field", field).withColumns({c: F.when(F.col(n) == "", F.lit("[Unknown]")).otherwise(F.col(c)) for c, n, _ in lost})
