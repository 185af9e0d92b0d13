"""Text expressions shared by the jobs: word sets, windows around matches, phrases.

Expressions here and in the sibling modules are Spark SQL text: a function takes the text
of its arguments and returns the text of its result. They nest freely, also under lambdas,
and a whole job's expression reaches the planner in one call (`F.expr`).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from itertools import count

from vitrine import fixed_values as fv

_names = count(1)


def literal(text: str) -> str:
    """A SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def each(array: str, build: Callable[[str], str]) -> str:
    """`transform` with a fresh variable name, so that expressions can nest."""
    name = f"x{next(_names)}"
    return f"transform({array}, {name} -> {build(name)})"


def keep(array: str, condition: Callable[[str], str]) -> str:
    """`filter` with a fresh variable name."""
    name = f"x{next(_names)}"
    return f"filter({array}, {name} -> {condition(name)})"


def let(value: str, build: Callable[[str], str]) -> str:
    """`build(value)` with the value computed once per row.

    Expressions under a lambda are not shared by the optimiser, so a value used several
    times is bound as the variable of a one-element transform.
    """
    return f"element_at({each(f'array({value})', build)}, 1)"


def one_of(value: str, words: Iterable[str]) -> str:
    return f"{value} IN ({', '.join(map(literal, words))})"


def _quoted(word: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}&~#-])", r"\\\1", word)


def alternation(words: Iterable[str]) -> str:
    """Literal alternatives, longest first so that a longer word is never cut short."""
    return "|".join(_quoted(w) for w in sorted(words, key=lambda w: (-len(w), w)))


def _by_first_letter(words: Iterable[str]) -> str:
    """Alternatives grouped by first letter, so that a position tries few of them."""
    groups: dict[str, list[str]] = {}
    for word in words:
        groups.setdefault(word[0], []).append(word[1:])
    return "|".join(f"{first}(?:{alternation(rests)})" for first, rests in sorted(groups.items()))


def matches(text: str, pattern: str) -> str:
    return f"({text} RLIKE {literal(pattern)})"


def contains_any(text: str, words: Iterable[str]) -> str:
    return matches(text, alternation(words))


def matches_lowered(text: str, pattern: str) -> str:
    """Does lower-case `text` match a pattern in lower case? Text that is all ASCII, as most is, need not be lowered."""
    plain = f"octet_length({text}) = char_length({text})"
    return f"(CASE WHEN {plain} THEN {matches(text, '(?i)' + pattern)} ELSE {matches(f'lower({text})', pattern)} END)"


def found(text: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({text}, {literal(pattern)}, {group})"


def replaced(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, {literal(pattern)}, {literal(by)})"


def lookup(mapping: Mapping[str, str], key: str) -> str:
    """Constant table as a map literal: a narrow lookup without a join; NULL when absent."""
    pairs = ", ".join(literal(x) for item in mapping.items() for x in item)
    return f"try_element_at(map({pairs}), {key})"


def lookup_number(mapping: Mapping[str, int], key: str) -> str:
    """Like `lookup`, with numbers."""
    pairs = ", ".join(f"{literal(name)}, {number}" for name, number in mapping.items())
    return f"try_element_at(map({pairs}), {key})"


def clean_text(text: str) -> str:
    """Whitespace runs (no-break space included) to one blank, ends trimmed."""
    return f"trim({replaced(text, r'(?U)\s+', ' ')})"


def bounded_words(text: str, words: Iterable[str], inside: str) -> str:
    """Every listed word in `text` that has no character of `inside` on either side.

    The match itself is zero-width with the word captured by look-ahead, so words that
    overlap ("for women" in "for women's clothing") are all found in one pass.
    """
    words = list(words)
    hits = found(text, rf"(?<![{inside}])(?=({_by_first_letter(words)})(?![{inside}]))", 1)
    # A position yields its longest word; shorter listed words that end inside it count too.
    within = {
        long: [w for w in words if w != long and long.startswith(w) and not re.match(f"[{inside}]", long[len(w)])]
        for long in words
    }
    cases = " ".join(
        f"WHEN {literal(long)} THEN array({', '.join(map(literal, [long, *short]))})" for long, short in within.items() if short
    )
    if not cases:
        return hits
    return f"flatten({each(hits, lambda w: f'CASE {w} {cases} ELSE array({w}) END')})"


def windows(text: str, anchor: str, before: int, after: int, guard: str = "") -> str:
    """Text around every match of `anchor`: `before` characters, the match, `after` characters.

    Windows may overlap. `guard` is a zero-width condition in front of the match.
    """
    tail = found(text, rf"(?is){guard}(?=({anchor}.{{0,{after}}}))", 1)
    if not before:
        return tail
    # Look-behind takes exactly `before` characters, or all there are from the start. Kept
    # apart, the first has a fixed width and the second fails at once away from the start.
    both = rf"(?is){guard}(?={anchor})(?:(?<=(.{{{before}}}))|(?<=(^.{{0,{before - 1}}})))"
    head = f"zip_with({found(text, both, 1)}, {found(text, both, 2)}, (a, b) -> concat(a, b))"
    return f"zip_with({head}, {tail}, (h, t) -> concat(h, t))"


def is_boilerplate_description(text: str) -> str:
    return contains_any(f"lower({text})", fv.DESCRIPTION_BOILERPLATE)


def near_third_party_marker(lowered: str, value: str) -> str:
    """A credit phrase within 100 characters of the first occurrence of `value` in lower-case text."""

    def near(at: str) -> str:
        start = f"greatest(1, {at} - {fv.CREDIT_CHARS})"
        context = f"substring({lowered}, {start}, {at} + length({value}) + {fv.CREDIT_CHARS} - {start})"
        return f"({at} > 0 AND {contains_any(context, fv.THIRD_PARTY_MARKERS)})"

    return let(f"instr({lowered}, lower({value}))", near)


def shows_rupees(text: str) -> str:
    return f"(contains({text}, '{fv.RUPEE_SIGN}') OR {matches(text, fv.RUPEE_WORDS)})"


def ships_to_india(text: str) -> str:
    return matches_lowered(text, fv.SHIPS_TO_INDIA)


def names_registered_office(text: str) -> str:
    return matches_lowered(text, fv.REGISTERED_OFFICE)


def is_yes(value: str) -> str:
    return one_of(f"lower(trim({value}))", fv.YES_WORDS)


def is_blank(value: str) -> str:
    return f"(coalesce(trim({value}), '') = '')"
