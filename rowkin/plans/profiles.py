"""Rule profiles: what differs between the variants of person resolution."""

from __future__ import annotations

from dataclasses import dataclass

DL, PASSPORT, TAX, GOV = "drivers_license_number", "passport_number", "tax_identification_number", "government_issued_id_number"
EMP, PHONE, OLD_PHONE, EMAIL = "employee_identification_number", "phone_number_personal", "phone_number", "email_address_personal"


@dataclass(frozen=True)
class Profile:
    """``id_levels``: match levels 3 and up, each on the tokens of one cell."""

    name: str
    id_levels: tuple[tuple[int, str], ...]
    evidence: tuple[str, ...]
    dob_alt: bool = True
    dob_floor: bool = False
    masked_ssn_confirms: bool = False
    middle_guard: bool = False
    suffix_mode: bool = True
    cluster_folds: bool = True
    nonpii: bool = True


_SIX = ((3, DL), (4, PASSPORT), (5, TAX), (6, GOV))
PROFILES = {
    p.name: p
    for p in (
        Profile("vf3", _SIX, (DL, PASSPORT, TAX, GOV), dob_floor=True),
        Profile("alt_dob", _SIX, (DL, PASSPORT, TAX, GOV), dob_alt=False, dob_floor=True),
        Profile("vf2", _SIX, (DL, PASSPORT, TAX, GOV)),
        Profile("vf", _SIX, (DL, PASSPORT, TAX, GOV), cluster_folds=False),
        Profile("new", _SIX[:3], (DL, PASSPORT, TAX), masked_ssn_confirms=True, middle_guard=True, suffix_mode=False, cluster_folds=False, nonpii=False),
    )
}
