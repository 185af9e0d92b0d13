"""E-mail and phone expressions."""

from __future__ import annotations

from vitrine import fixed_values as fv
from vitrine.functions.text import each, found, keep, let, literal, matches, one_of, replaced

SPELLED_AT = r"(?i)\[at\]|\(at\)|\sat\s"
# One run of digits with the separators people put inside a number, however long, and the letter or
# sign touching it, which shows that the digits belong to something else.
PHONE_RUN = "[A-Za-z%₹$€£]?[+]?[0-9][0-9 ().-]{6,}[0-9][A-Za-z%]?"
TOUCHED_RUN = "^[A-Za-z%₹$€£]|[A-Za-z%]$"
INDIAN_MOBILE = "[6-9][0-9]{9}"
# Indian toll-free and shared-cost series, written without a trunk 0.
SERVICE_NUMBER = "1800[0-9]{6,7}|1860[0-9]{7}"
# Numbering-plan lengths (digits after the country code) for other countries.
FOREIGN_LENGTHS = {
    "1": (10, 10), "7": (10, 10), "20": (9, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9),
    "34": (9, 9), "36": (8, 9), "39": (9, 11), "40": (9, 9), "41": (9, 9), "43": (10, 13), "44": (10, 10), "45": (8, 8),
    "46": (7, 10), "47": (8, 8), "48": (9, 9), "49": (10, 11), "51": (8, 9), "52": (10, 10), "54": (10, 11), "55": (10, 11),
    "56": (9, 9), "57": (8, 10), "58": (10, 10), "60": (8, 10), "61": (9, 9), "62": (9, 12), "63": (10, 10), "64": (8, 10),
    "65": (8, 8), "66": (8, 9), "81": (9, 10), "82": (8, 10), "84": (9, 10), "86": (11, 11), "90": (10, 10), "92": (10, 10),
    "93": (9, 9), "94": (9, 9), "95": (7, 10), "98": (10, 10), "212": (9, 9), "213": (8, 9), "216": (8, 8), "230": (7, 8),
    "233": (9, 9), "234": (8, 10), "254": (9, 9), "255": (9, 9), "256": (9, 9), "351": (9, 9), "353": (8, 9), "358": (7, 10),
    "359": (8, 9), "370": (8, 8), "371": (8, 8), "372": (7, 8), "380": (9, 9), "385": (8, 9), "386": (8, 8), "420": (9, 9),
    "421": (9, 9), "506": (8, 8), "507": (7, 8), "593": (8, 9), "852": (8, 8), "855": (8, 9), "856": (8, 10), "880": (10, 10),
    "886": (8, 9), "960": (7, 7), "961": (7, 8), "962": (8, 9), "965": (8, 8), "966": (9, 9), "968": (8, 8), "971": (8, 9),
    "972": (8, 9), "973": (8, 8), "974": (8, 8), "975": (7, 8), "976": (8, 8), "977": (8, 10),
}
# Country codes of three digits by what they begin with and how they may go on; those without lengths
# of their own above have numbers of seven to nine digits.
THREE_DIGIT_CODES = {
    "21": "1-368", "22": "0-9", "23": "0-9", "24": "0-9", "25": "0-8", "26": "0-9", "29": "01789", "35": "0-9", "37": "0-9", "38": "0-35-79",
    "42": "013", "50": "0-9", "59": "0-9", "67": "02-9", "68": "0-35-9", "69": "0-2", "85": "02356", "88": "06", "96": "0-8", "97": "0-79", "99": "2-68",
}
OTHER_LENGTHS = (7, 9)


def _numbers(digit: str, repeated: str) -> str:
    """A pattern of all foreign numbers after the sign. Its alternatives share their first digits, so it is matched
    as one automaton. `digit` is a digit, `repeated` one more of them."""

    def spread(code: str) -> str:
        return code[0] + "".join(repeated.replace(digit, c) for c in code[1:])

    own = [f"{spread(cc)}(?:{repeated}){{{low},{high}}}" for cc, (low, high) in FOREIGN_LENGTHS.items()]
    low, high = OTHER_LENGTHS
    rest = [f"{spread(start)}{repeated.replace(digit, f'[{more}]')}(?:{repeated}){{{low},{high}}}" for start, more in THREE_DIGIT_CODES.items()]
    return "|".join(own + rest)


def _known_codes() -> str:
    return "|".join(cc for cc in FOREIGN_LENGTHS if len(cc) == 3)


_FOREIGN = _numbers("[0-9]", "[0-9]")
# Codes with lengths of their own must have those.
_OWN = "|".join(f"{cc}[0-9]{{{low},{high}}}" for cc, (low, high) in FOREIGN_LENGTHS.items())
KNOWN_CODE, KNOWN_NUMBER = f"^(?:{_known_codes()})", f"^(?:{_OWN})$"
INDIAN_NUMBER = f"91{INDIAN_MOBILE}|91[1-5][0-9]{{9}}|91(?:{SERVICE_NUMBER})"
# In a run that is no number: numbers from the start of a group of digits to the end of one.
_MORE = "[ ().-]{0,3}[0-9]"
NUMBER_IN_RUN = (
    rf"[A-Za-z%₹$€£]?(?:(?:[+]|\b0[ ().-]{{0,3}}0[ ().-]{{0,3}})(?:9{_MORE.replace('[0-9]', '1')}[ ().-]{{0,3}}[6-9](?:{_MORE}){{9}}|{_numbers('[0-9]', _MORE)})"
    rf"|\b(?:9{_MORE.replace('[0-9]', '1')}[ ().-]{{0,3}}|0[ ().-]{{0,3}})?[6-9](?:{_MORE}){{9}})\b[A-Za-z%]?"
)


def plain_emails(text: str) -> str:
    return each(found(text, fv.EMAIL, 1), lambda e: replaced(f"lower({e})", "^[.,;:]+|[.,;:]+$"))


def spelled_emails(text: str) -> str:
    """`sales [at] brand [dot] in` and its variants, in plain form."""
    user, host, zone = (found(text, fv.SPELLED_EMAIL, group) for group in (1, 2, 3))
    address = f"zip_with({user}, {host}, (u, h) -> concat(u, '@', h))"
    return f"zip_with({address}, {zone}, (a, z) -> lower(concat(a, '.', z)))"


def is_placeholder_email(email: str) -> str:
    prefixes = "|".join(p.replace("-", "[-]") for p in fv.EMAIL_BLOCKED_PREFIXES)
    suffixes = "|".join(s.replace(".", "[.]") for s in fv.EMAIL_BLOCKED_SUFFIXES)
    return matches(email, f"^({prefixes})|({suffixes})$")


def extract_emails(text: str) -> str:
    none = "cast(array() AS array<string>)"
    # Most texts hold neither form: a plain search spares them the long patterns.
    plain = f"CASE WHEN contains({text}, '@') THEN {plain_emails(text)} ELSE {none} END"
    spelled = f"CASE WHEN {matches(text, SPELLED_AT)} THEN {spelled_emails(text)} ELSE {none} END"
    allowed = keep(f"concat({plain}, {spelled})", lambda e: "NOT " + is_placeholder_email(e))
    return f"array_sort(array_distinct({allowed}))"


def _to_e164(run: str) -> str:
    """International form of one digit run read with default country India; NULL if invalid. An international
    number starts with + or, as dialled from India, with 00."""

    def rules(digits: str) -> str:
        national = replaced(digits, "^0+")
        foreign = f"{matches(national, f'^(?:{_FOREIGN})$')} AND (NOT {matches(national, KNOWN_CODE)} OR {matches(national, KNOWN_NUMBER)})"
        return f"""CASE
          WHEN {matches(run, TOUCHED_RUN)} THEN NULL
          WHEN startswith({run}, '+') OR startswith({digits}, '00') THEN CASE
            WHEN startswith({run}, '+') AND startswith({digits}, '0') THEN NULL
            WHEN {matches(national, f"^(?:{INDIAN_NUMBER})$")} OR ({foreign}) THEN concat('+', {national}) END
          WHEN {matches(digits, f"^0?{INDIAN_MOBILE}$")} THEN concat('+91', {national})
          WHEN {matches(digits, f"^91{INDIAN_MOBILE}$")} THEN concat('+', {digits})
          WHEN {matches(digits, f"^(?:{SERVICE_NUMBER})$")} THEN concat('+91', {digits})
          -- A land line is written with its trunk 0 and a two- to four-digit area code.
          WHEN {matches(digits, "^0[1-5][0-9]{9}$")} THEN concat('+91', {national})
        END"""

    return let(replaced(run, "[^0-9]"), rules)


def extract_phones(text: str) -> str:
    """Valid numbers in E.164, sorted. A run that is no number may hold several: they are read from left to right."""

    def numbers(run: str) -> str:
        return let(
            _to_e164(run),
            lambda number: f"CASE WHEN {number} IS NOT NULL THEN array({number}) "
            f"ELSE {each(found(run, NUMBER_IN_RUN), _to_e164)} END",
        )

    valid = keep(f"flatten({each(found(text, PHONE_RUN), numbers)})", lambda p: f"{p} IS NOT NULL")
    return f"array_sort(array_distinct({valid}))"


def indian_phones(text: str) -> str:
    return keep(extract_phones(text), lambda p: f"startswith({p}, '+91')")


def whatsapp_phone(href: str) -> str:
    """Indian mobile number of a chat link; NULL for any other link."""
    authority = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
    host = f"lower(regexp_extract({href}, {literal(authority + r'(?:[^/@]*@)?([^/:?#]+)')}, 1))"
    path = replaced(f"regexp_extract({href}, {literal(authority + '[^/?#]*([^?#]*)')}, 1)", "^/+|/+$")
    param = replaced(f"regexp_extract({href}, '[?&]phone=([^&#]*)', 1)", "%2[Bb]")

    def number(raw: str) -> str:
        digits = replaced(f"coalesce(nullif({raw}, ''), {param})", "[^0-9]")
        return let(digits, lambda d: f"CASE WHEN {matches(d, '^91[0-9]{10}$')} THEN concat('+', {d}) END")

    is_chat = one_of(replaced(host, r"^www\."), fv.WHATSAPP_HOSTS)
    return f"CASE WHEN {is_chat} THEN {let(path, number)} END"
