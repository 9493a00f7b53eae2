"""Postal address cells taken apart: house number, unit, street words, city words, zip."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

# Postal abbreviations of street types, directions, unit words and parts of city names.
TYPES = {
    "STREET": ("STREET", "ST", "STR", "STRT"),
    "ROAD": ("ROAD", "RD"),
    "AVENUE": ("AVENUE", "AVE", "AV", "AVEN", "AVNUE"),
    "DRIVE": ("DRIVE", "DR", "DRV"),
    "COURT": ("COURT", "CT", "CRT"),
    "LANE": ("LANE", "LN"),
    "BOULEVARD": ("BOULEVARD", "BLVD", "BOUL", "BLV"),
    "PLACE": ("PLACE", "PL", "PLC"),
    "PARKWAY": ("PARKWAY", "PKWY", "PKY", "PWY"),
    "TERRACE": ("TERRACE", "TER", "TERR"),
    "CIRCLE": ("CIRCLE", "CIR", "CIRC", "CRCL"),
    "TRAIL": ("TRAIL", "TRL", "TR"),
    "WAY": ("WAY", "WY"),
    "HIGHWAY": ("HIGHWAY", "HWY"),
    "SQUARE": ("SQUARE", "SQ"),
    "ALLEY": ("ALLEY", "ALY"),
    "CRESCENT": ("CRESCENT", "CRES"),
}
DIRECTIONS = {
    "NORTH": ("NORTH", "N", "NO", "NTH"),
    "SOUTH": ("SOUTH", "S", "SO", "STH"),
    "EAST": ("EAST", "E"),
    "WEST": ("WEST", "W"),
    "NORTHEAST": ("NORTHEAST", "NE"),
    "NORTHWEST": ("NORTHWEST", "NW"),
    "SOUTHEAST": ("SOUTHEAST", "SE"),
    "SOUTHWEST": ("SOUTHWEST", "SW"),
}
UNITS = ("APARTMENT", "APT", "UNIT", "SUITE", "STE", "ROOM", "RM", "FLAT", "NUMBER", "APMT", "APPT", "#")
CITY_WORDS = {
    "SAINT": ("SAINT", "ST", "STE", "SAINTE"),
    "FORT": ("FORT", "FT"),
    "MOUNT": ("MOUNT", "MT"),
    "HEIGHTS": ("HEIGHTS", "HTS", "HGTS"),
    "SPRINGS": ("SPRINGS", "SPGS", "SPRGS"),
    "FALLS": ("FALLS", "FLS"),
    "JUNCTION": ("JUNCTION", "JCT"),
    **DIRECTIONS,
}
# Abbreviations of words in street names that are not types
STREET_WORDS = {"JUNCTION": ("JCT",), "SPRINGS": ("SPGS", "SPRGS"), "MOUNT": ("MT",), "HEIGHTS": ("HTS",), "LANDING": ("LNDG",)}
GLUED = ("JCT", "HTS", "HGTS", "SPGS", "SPRGS", "FLS")  # also found without a blank before them
ORDINALS = ("FIRST", "SECOND", "THIRD", "FOURTH", "FIFTH", "SIXTH", "SEVENTH", "EIGHTH", "NINTH", "TENTH", "ELEVENTH", "TWELFTH")
STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD "
    "TN TX UT VT VA WA WV WI WY DC ON QC MB AB BC"
).split()
# Cells that name no place (letters and digits, upper case).
NO_PLACE = {
    "", "UNKNOWN", "UNK", "NA", "NONE", "NULL", "NIL", "NAN", "NONEGIVEN", "NOTGIVEN", "NOTPROVIDED", "NOTKNOWN", "SAMEASABOVE",
    "ADDRESSONFILE", "ONFILE", "NOFIXEDADDRESS", "SEEATTACHEDFORM", "SEEATTACHED", "REDACTED", "MISSING", "PENDING", "TBD", "HOMELESS", "XXX",
}


def _full(table: dict[str, tuple[str, ...]]) -> dict[str, str]:
    return {short: name for name, forms in table.items() for short in forms}


TYPE, DIRECTION, CITY = _full(TYPES), _full(DIRECTIONS), _full(CITY_WORDS)
WORD = _full(STREET_WORDS) | {f"{i}{'ST' if i == 1 else 'ND' if i == 2 else 'RD' if i == 3 else 'TH'}": w for i, w in enumerate(ORDINALS, 1)}
FILLERS = {"", "ADDRESS", "USA", "US", "UNITEDSTATES", "CANADA"}


class Place(NamedTuple):
    number: str
    unit: str
    street: tuple[str, ...]  # name words in order, without direction and type
    direction: str
    type: str
    city: tuple[str, ...]
    zip: str


_SPACES = {c: " " for c in range(128) if chr(c).isspace()}


def folded(text: str | None) -> str:
    """Upper case ASCII letters of a cell; accents and unusual blanks gone."""
    if not isinstance(text, str):
        return ""
    if text.isascii():
        return text.translate(_SPACES).upper()
    text = unicodedata.normalize("NFKD", text).upper().replace("Ł", "L").replace("Ø", "O").replace("ß", "SS")
    return "".join(" " if c.isspace() or unicodedata.category(c) in ("Cf", "Zs") else c for c in text if not unicodedata.combining(c))


@lru_cache(50_000)
def zip5(text: str | None) -> str:
    text = folded(text)
    if m := re.fullmatch(r"\s*([A-Z]\d[A-Z])[ -]*(\d[A-Z]\d)\s*", text):
        return m[1] + m[2]
    digits = re.sub(r"\D", "", text)
    if not digits:
        return ""
    return digits[:5] if len(digits) in (5, 9) else digits.zfill(5) if len(digits) < 5 else digits[:-4].zfill(5) if len(digits) < 9 else digits[:5]


@lru_cache(50_000)
def city_words(text: str | None) -> tuple[str, ...]:
    words = re.findall(r"[A-Z0-9']+", folded(text).replace(".", " "))
    if "".join(words) in NO_PLACE:
        return ()
    out = []
    for w in words:
        glued = next((x for x in GLUED if w.endswith(x) and len(w) > len(x) + 3 and w not in CITY), "")
        out += [w[: -len(glued)], glued] if glued else [w]
    return tuple(CITY.get(w, w) for w in out)


_TAIL = re.compile(r",\s*([^,0-9]+?)\s*,\s*([A-Z]{2})\s*,?\s*(\d{5}(?:-?\d{4})?|\d{3,4}|[A-Z]\d[A-Z] ?\d[A-Z]\d)?\s*(?:,\s*[A-Z .]+)?$")
_UNIT = re.compile(r"(?:\b(?:APARTMENT|APPT|APMT|APT|UNIT|SUITE|STE|ROOM|RM|FLAT)\b\.?\s*(?:#|NO\.?)?|#)\s*([A-Z0-9]+(?:-[A-Z0-9]+)?)")


def parsed(address: str | None, city: str | None, zip_code: str | None) -> Place | None:
    """The parts of an address; None if it has no house number or no street word, so names no location."""
    text = folded(address)
    if re.sub(r"[^A-Z0-9]", "", text) in NO_PLACE:
        return None
    town, code = city_words(city), zip5(zip_code)
    if m := _TAIL.search(text):
        text = text[: m.start()]
        town, code = town or city_words(m[1]), code or zip5(m[3])
    unit = ""
    if m := _UNIT.search(text):
        unit = m[1]
        text = text[: m.start()] + " " + text[m.end() :]
    words = re.findall(r"[A-Z0-9]+(?:-[A-Z0-9]+)?|'", text.replace(".", " ").replace("'", ""))
    number, rest = "", []
    for w in words:
        if not number and (m := re.fullmatch(r"([A-Z0-9]+)-(\d+)([A-Z]?)", w)) and not unit:
            unit, number = m[1], m[2]
        elif not number and (m := re.fullmatch(r"(\d+)([A-Z]?)", w)):
            number, unit = m[1], unit or m[2]
        elif re.fullmatch(r"\d+", w) and number and not unit:
            unit = w
        else:
            rest += w.split("-")
    if not number:
        return None
    direction = kind = ""
    ws = [w for w in rest if w]
    # the type is the last word, or the one before a trailing direction
    if len(ws) > 1 and ws[-1] in DIRECTION:
        direction = DIRECTION[ws.pop()]
    if len(ws) > 1 and ws[-1] in TYPE:
        kind = TYPE[ws.pop()]
    elif len(ws) > 1 and not unit and len(ws[-1]) == 1 and ws[-2] in TYPE:
        unit = ws.pop()
        kind = TYPE[ws.pop()]
    if not unit and len(ws) > 1 and len(ws[0]) == 1 and (ws[0] not in DIRECTION or (len(ws) > 2 and ws[1] in DIRECTION)):
        unit = ws.pop(0)
    if not direction and len(ws) > 1 and ws[0] in DIRECTION:
        direction = DIRECTION[ws.pop(0)]
    ws = [WORD.get(w, w) for w in ws]
    if not any(len(w) > 1 for w in ws):
        return None
    return Place(number.lstrip("0") or "0", unit.lstrip("0") or unit, tuple(ws), direction, kind, town, code)
