"""Columns of the person tables, and the profiles that read them."""

from __future__ import annotations

NAMES = ("first_name", "last_name", "middle_name", "suffix")
ADDRESS = ("residential_address", "city", "state_of_residence", "province_of_residence", "zip_code", "country_of_residence")
MATCH_IDS = ("drivers_license_number", "passport_number", "tax_identification_number", "government_issued_id_number")
CONTACT = ("employee_identification_number", "phone_number_personal", "email_address_personal", "work_related_information")
OTHER = (
    "data_subject_type", "birth_information", "address_comments", "contact_information", "dl_issuing_country", "dl_issuing_province",
    "dl_issuing_state", "passport_country", "government_id_issuing_country", "government_issued_identification",
    "health_related_information", "family_information", "financial_account_information", "demographic_information",
    "biometric_data", "pi_notes", "access_credentials_non_financial",
)

VF3_COLUMNS = ("docids", *NAMES, "full_date_of_birth", "dobs", "social_security_number", "unique_id", *ADDRESS, *MATCH_IDS, *CONTACT, *OTHER)
VF3_TABLE = ("rec_id", *VF3_COLUMNS, "received_at")
OLD_COLUMNS = tuple(
    "phone_number" if c == "phone_number_personal" else c for c in VF3_COLUMNS if c not in ("dobs", "unique_id", "tax_identification_number")
) + ("student_related_information",)


def missing(columns: list[str], required: tuple[str, ...]) -> list[str]:
    return [c for c in required if c not in columns]


def require(columns: list[str], required: tuple[str, ...]) -> None:
    """ValueError that names the missing columns; extra columns are fine."""
    if lost := missing(columns, required):
        raise ValueError(f"missing columns: {', '.join(lost)}")
