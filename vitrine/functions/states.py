"""State expressions: tax numbers, state names, postal codes."""

from __future__ import annotations

from vitrine import fixed_values as fv
from vitrine.functions.text import bounded_words, each, found, keep, let, lookup, matches, replaced

STATE_ALIASES = {name.lower(): name for name in fv.GST_STATES.values() if name != fv.NOT_A_STATE_NAME}
STATE_ALIASES |= fv.EXTRA_STATE_ALIASES


def _sorted_distinct(array: str) -> str:
    return f"array_sort(array_distinct({array}))"


def find_gstins(text: str) -> str:
    return _sorted_distinct(each(found(text, fv.GSTIN), lambda g: f"upper({g})"))


def state_from_gstin(gstin: str) -> str:
    return f"coalesce({lookup(fv.GST_STATES, f'left({gstin}, 2)')}, '')"


def find_states(text: str) -> str:
    """Canonical names of the states mentioned, sorted."""
    plain = replaced(f"lower({text})", r"(?U)\s+", " ")
    aliases = bounded_words(plain, STATE_ALIASES, "a-z")
    return _sorted_distinct(each(aliases, lambda alias: lookup(STATE_ALIASES, alias)))


def find_pins(text: str) -> str:
    """Six-digit codes not inside longer digit runs, sorted."""
    runs = keep(f"split({text}, '[^0-9]+')", lambda run: matches(run, f"^{fv.PIN}$"))
    return _sorted_distinct(runs)


def has_indian_pin(text: str) -> str:
    return matches(text, fv.PIN_GUARD + fv.PIN)


def state_from_pin(pin: str) -> str:
    """Three-digit prefix first, then two digits; "" for circles shared by several states."""

    def by_prefix(digits: str) -> str:
        three, two = lookup(fv.PIN3_STATES, f"left({digits}, 3)"), lookup(fv.PIN2_STATES, f"left({digits}, 2)")
        return f"CASE WHEN length({digits}) = 6 THEN coalesce({three}, {two}, '') ELSE '' END"

    return let(replaced(pin, "[^0-9]"), by_prefix)


def region_state(text: str) -> str:
    """The single state an address region stands for; NULL without a PIN or when ambiguous."""

    def single(states: str) -> str:
        return f"CASE WHEN size({states}) = 1 THEN {states}[0] END"

    def named_or_by_pin(pins: str) -> str:
        by_pin = f"array_except(array_distinct({each(pins, state_from_pin)}), array(''))"
        return let(
            find_states(text),
            lambda named: f"CASE WHEN size({named}) > 0 THEN {single(named)} ELSE {let(by_pin, single)} END",
        )

    return let(find_pins(text), lambda pins: f"CASE WHEN size({pins}) > 0 THEN {named_or_by_pin(pins)} END")


