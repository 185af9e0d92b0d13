"""Page bodies to element facts, once per page.

One Arrow pass turns each body into its text plus a list of the elements the jobs look
at. An element keeps its place in the text as an offset and a length, never a copy, so a
page's facts grow with the page however deeply its elements nest. All selecting and
scoring happens afterwards in Spark expressions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions.text import contains_any, matches
from vitrine.functions.urls import page_role

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Text under these is not shown to a visitor …
HIDDEN = frozenset("script style noscript svg template".split())
# … and text under these is no part of an enclosing element's own text.
OPAQUE = frozenset("script style template rt rp".split())
COVERED = HIDDEN | OPAQUE
ROOTS = ("main", "body")
KEPT_TAGS = frozenset("title h1 h2 a img meta footer address main article body p".split())
KEPT_ATTRIBUTES = frozenset(
    "href content name property class id itemtype alt src data-src data-lazy-src data-original srcset "
    "data-srcset width height".split()
)
MARKERS = ("header", "nav", "main", "article", "hero", "home_link", "home_dot_link")
MARKED = re.compile("contact|address|banner__text|hero", re.I)

ELEMENT = pa.struct(
    [
        ("tag", pa.string()),
        ("attrs", pa.map_(pa.string(), pa.string())),
        ("within", pa.list_(pa.string())),
        ("start", pa.int32()),
        ("len", pa.int32()),
    ]
)
FACT_FIELDS = [
    ("text", pa.string()),
    ("full_text", pa.string()),
    ("content_start", pa.int32()),
    ("content_len", pa.int32()),
    ("ld_json", pa.list_(pa.string())),
    ("elements", pa.list_(ELEMENT)),
]
FACT_DDL = (
    "text string, full_text string, content_start int, content_len int, ld_json array<string>, "
    "elements array<struct<tag:string,attrs:map<string,string>,within:array<string>,start:int,len:int>>"
)
SLICE_ROWS, SLICE_BYTES = 64, 4 << 20

# Tags whose reading needs no tolerance: known letters in the name, attributes bare or quoted, one end.
_NAME, _SPACE = "[a-zA-Z][a-zA-Z0-9:_-]*", r"[ \t\r\n\f]"
_PLAIN_TAG = re.compile(rf"""<(?:/({_NAME}){_SPACE}*>|({_NAME})((?:{_SPACE}+{_NAME}(?:="[^"]*"|='[^']*')?)*){_SPACE}*(/?)>)""")
_PLAIN_ATTRIBUTE = re.compile(rf"""({_NAME})(?:="([^"]*)"|='([^']*)')?""")
# Elements that the standard parser reads up to their end tag: as it is, or with references resolved.
_RAW = frozenset(HTMLParser.CDATA_CONTENT_ELEMENTS)
_RESOLVED = frozenset(getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()))
_LITERAL = _RAW | _RESOLVED | {"plaintext"}
_CLOSING = {tag: re.compile(rf"</\s*{tag}" if tag in _RAW else "<", re.I) for tag in _LITERAL}


def _plain_attributes(text: str) -> list[tuple[str, str | None]]:
    found = []
    for m in _PLAIN_ATTRIBUTE.finditer(text):
        value = m[2] if m[2] is not None else m[3]
        found.append((m[1].lower(), unescape(value) if value and "&" in value else value))
    return found


def _after_comment(body: str, at: int) -> int:
    """The place behind a doctype or a comment that all readers end there; -1 for anything else."""
    if body.startswith("<!--", at):
        dashes = body.find("--", at + 4)
        return dashes + 3 if dashes > at + 4 and body[at + 4] != ">" and body.startswith("-->", dashes) else -1
    return body.find(">", at + 9) + 1 or -1 if body[at : at + 9].lower() == "<!doctype" else -1


def _literal_end(body: str, tag: str, at: int) -> int:
    """Where the end tag of a script, style or the like begins that is opened before `at`; -1 if that is not plain."""
    closing = _CLOSING[tag].search(body, at)
    if closing is None or tag == "plaintext" or body.find("<!--", at, closing.start()) >= 0:
        return -1
    end = closing.start()
    return end if body[end : end + len(tag) + 3].lower() == f"</{tag}>" else -1


class _PageEvents(HTMLParser):
    """Collects text pieces and element facts while the standard parser walks a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.shown: list[str] = []  # pieces of the visible text
        self.owned: list[str] = []  # pieces of the elements' own text
        self.elements: list[dict] = []
        self.ld_json: list[str] = []
        self.content: dict[str, tuple[int, int]] = {}
        self._first: dict[str, dict | None] = {}
        self._open: list[tuple[str, dict | None, int, int, tuple[str, ...]]] = []
        self._depth: dict[str, int] = {}
        self._buffer: list[str] = []
        self._ld: list[str] | None = None
        self._hidden = self._opaque = self._marked = 0
        self._marks = dict.fromkeys(MARKERS, 0)

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not needed

    def _flush(self) -> None:
        buffer = self._buffer
        text = buffer[0] if len(buffer) == 1 else "".join(buffer)
        buffer.clear()
        piece = " ".join((unescape(text) if "&" in text else text).split())
        if not piece:
            return
        if not self._hidden:
            self.shown.append(piece)
        if not self._opaque:
            self.owned.append(piece)

    def handle_data(self, data: str) -> None:
        if self._ld is not None:
            self._ld.append(data)
        else:
            self._buffer.append(data)

    def handle_comment(self, data: str) -> None:
        if self._buffer:
            self._flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._buffer:
            self._flush()
        values = {name: value or "" for name, value in attrs if name in KEPT_ATTRIBUTES}
        fact = None
        if self._is_asked_for(tag, values):
            if "content" in values:
                values["content"] = unescape(values["content"])
            within = [m for m in MARKERS if self._marks[m]] if self._marked else []
            fact = {"tag": tag, "attrs": list(values.items()), "within": within, "start": 0, "len": 0}
            self.elements.append(fact)
        if tag in VOID:
            return
        if tag == "script" and (dict(attrs).get("type") or "").lower() == "application/ld+json":
            self._ld = []
        markers = self._markers_of(tag, values)
        for marker in markers:
            self._marks[marker] += 1
            self._marked += 1
        if tag in ROOTS:
            self._first.setdefault(tag, fact)
        if tag in COVERED:
            self._hidden += tag in HIDDEN
            self._opaque += tag in OPAQUE
        self._open.append((tag, fact, len(self.shown), len(self.owned), markers))
        self._depth[tag] = self._depth.get(tag, 0) + 1

    def _is_asked_for(self, tag: str, values: dict) -> bool:
        if tag == "a":
            listed = "href" in values
        elif tag == "p":  # other paragraphs than those in content are never asked for
            listed = bool(self._marks["main"] or self._marks["article"] or self._marks["hero"])
        else:
            listed = tag in KEPT_TAGS
        if listed or not values:
            return listed
        return (
            ("class" in values and MARKED.search(values["class"]) is not None)
            or ("id" in values and MARKED.search(values["id"]) is not None)
            or "PostalAddress" in values.get("itemtype", "")
        )

    def _markers_of(self, tag: str, values: dict) -> tuple[str, ...]:
        markers = (tag,) if tag in MARKERS else ()
        if "class" in values and "hero" in values["class"].lower():
            markers += ("hero",)
        if tag == "a" and self._marks["header"] and values.get("href") in ("/", "./"):
            markers += ("home_link" if values["href"] == "/" else "home_dot_link",)
        return markers

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self._buffer:
            self._flush()
        if tag == "script" and self._ld is not None:
            self.ld_json.append(_without_references("".join(self._ld)))
            self._ld = None
        while self._depth.get(tag):
            if self._close_last() == tag:
                break

    def _close_last(self) -> str:
        tag, fact, shown, owned, markers = self._open.pop()
        self._depth[tag] -= 1
        for marker in markers:
            self._marks[marker] -= 1
            self._marked -= 1
        if tag in COVERED:
            self._hidden -= tag in HIDDEN
            self._opaque -= tag in OPAQUE
        if fact is not None:
            fact["start"], fact["len"] = owned, len(self.owned)
            if tag in ROOTS and fact is self._first[tag]:
                self.content[tag] = (shown, len(self.shown))
        return tag

    def _read_plain(self, body: str) -> int:
        """Calls the handlers as the standard parser does while the markup is plain, and returns the place of the
        first thing that is not."""
        at = 0
        while (tag_at := body.find("<", at)) >= 0:
            if at < tag_at:
                text = body[at:tag_at]
                self.handle_data(unescape(text) if "&" in text else text)
            found = _PLAIN_TAG.match(body, tag_at)
            if found is None:
                at = _after_comment(body, tag_at)
                if at < 0:
                    return tag_at
                self.handle_comment("")
                continue
            at = found.end()
            closed, opened, attributes, alone = found.groups()
            if closed:
                self.handle_endtag(closed.lower())
                continue
            tag = opened.lower()
            literal_end = _literal_end(body, tag, at) if tag in _LITERAL else None
            if literal_end is not None and (alone or literal_end < 0):
                return tag_at
            attrs = _plain_attributes(attributes) if attributes else []
            if alone:
                self.handle_startendtag(tag, attrs)
                continue
            self.handle_starttag(tag, attrs)
            if literal_end is not None:
                if at < literal_end:
                    self.handle_data(unescape(body[at:literal_end]) if tag in _RESOLVED else body[at:literal_end])
                at = literal_end
        return at

    def facts(self, body: str) -> dict:
        try:
            self.feed(body[self._read_plain(body) :])
            self.close()
        except AssertionError:  # the parser gives up on this markup: keep what was read
            pass
        if self._buffer:
            self._flush()
        if self._ld is not None:
            self.ld_json.append(_without_references("".join(self._ld)))
        while self._open:
            self._close_last()
        at = _offsets(self.owned)
        for fact in self.elements:
            first, last = fact["start"], max(fact["start"], fact["len"])
            fact["start"], fact["len"] = at[first] + 1, max(0, at[last] - at[first] - 1)
        shown_at = _offsets(self.shown)
        first, last = self.content.get("main") or self.content.get("body") or (0, len(self.shown))
        text, own = " ".join(self.shown), " ".join(self.owned)
        return {
            "text": text,
            "full_text": None if own == text else own,
            "content_start": shown_at[first] + 1,
            "content_len": max(0, shown_at[last] - shown_at[first] - 1),
            "ld_json": self.ld_json,
            "elements": self.elements,
        }


# Members whose strings are shown as text; others, like addresses of pages, stay as they are.
_TEXT_MEMBER = re.compile(r'"(name|description|category|productType)"\s*:\s*("(?:[^"\\]|\\.)*")', re.S)


def _without_references(script: str) -> str:
    """A JSON-LD script whose text members have all character references resolved, as page text has."""
    if "&" not in script and "\\u0026" not in script:
        return script

    def plain(member: re.Match) -> str:
        try:
            return f'"{member[1]}": {json.dumps(unescape(json.loads(member[2], strict=False)), ensure_ascii=False)}'
        except ValueError:
            return member[0]

    return _TEXT_MEMBER.sub(plain, script)


def _offsets(pieces: list[str]) -> list[int]:
    """Character offset of every piece in the blank-joined text, and one past the end."""
    at = [0]
    for piece in pieces:
        at.append(at[-1] + len(piece) + 1)
    return at


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts of the bodies, given out every few rows or megabytes: memory is that of the largest body."""
    for batch in batches:
        bodies = batch.column(batch.schema.get_field_index("body"))
        ends = np.cumsum(pc.fill_null(pc.binary_length(bodies), 0).to_numpy()) // SLICE_BYTES
        start = 0
        while start < batch.num_rows:
            end = min(start + SLICE_ROWS, int(np.searchsorted(ends, ends[start], "right")))
            yield _facts_of(batch.slice(start, end - start))
            start = end


def _facts_of(part: pa.RecordBatch) -> pa.RecordBatch:
    rows = [_PageEvents().facts(body.as_py() or "") for body in part.column(part.schema.get_field_index("body"))]
    names = [n for n in part.schema.names if n != "body"]
    columns = [part.column(part.schema.get_field_index(n)) for n in names]
    columns += [pa.array([row[name] for row in rows], type=kind) for name, kind in FACT_FIELDS]
    return pa.RecordBatch.from_arrays(columns, names=names + [name for name, _ in FACT_FIELDS])


def unusable_home_reason(status: str = "status_code", body: str = "body", lowered: str | None = None) -> str:
    """Why a home page cannot be a live storefront; NULL when it can. `lowered`: the body in lower case, if at hand."""
    lowered = lowered or f"lower({body})"
    return f"""CASE
      WHEN coalesce({status}, 0) >= 400 OR coalesce({body}, '') = '' THEN concat('homepage_status_', coalesce({status}, 0))
      WHEN {contains_any(lowered, fv.PASSWORD_MARKERS)} THEN 'password_protected'
      WHEN {contains_any(lowered, fv.PARKED_MARKERS)} THEN 'parked_domain'
      WHEN contains({lowered}, '{fv.CAPTCHA_MARKER}') AND length({body}) < {fv.CAPTCHA_MAX_CHARS} THEN 'captcha_only'
    END"""


def usable_pages(pages: DataFrame) -> DataFrame:
    """Home pages, and other pages that are allowed, found and HTML; whole bodies."""
    secondary = (
        F.col("robots_allowed") & (F.col("status_code") < 400) & F.lower("content_type").contains("html")
    )
    return pages.where((F.col("page_seq") == 0) | secondary)


def raw_facts(pages: DataFrame) -> DataFrame:
    """What the jobs take from raw markup, headers and addresses, without parsing."""
    headers = ", ".join(f"'{name}'" for name in fv.PLATFORM_HEADERS)
    # Lowered once: as a column of its own, which the optimiser keeps apart as it is read several times.
    return pages.withColumn("_lowered", F.lower("body")).selectExpr(
        "store_id",
        "page_seq",
        *(["fetched_at"] if "fetched_at" in pages.columns else []),
        "final_url AS url",
        f"{page_role('final_url')} AS role",
        f"{matches('body', fv.RUNTIME)} AS has_runtime",
        "contains(_lowered, '/cdn/shop/') OR contains(_lowered, 'cdn.shopify.com') AS has_cdn",
        "contains(_lowered, 'shopify-section') OR contains(_lowered, 'shopify-payment-button') AS has_markup",
        f"""CASE WHEN page_seq = 0 THEN named_struct('home_url', final_url, 'requested_url', requested_url, 'home_reason',
          CASE WHEN NOT robots_allowed THEN 'robots_disallowed' ELSE {unusable_home_reason(lowered="_lowered")} END,
          'redirect_history', redirect_history) END AS head""",
        f"array_join(array_sort(array_intersect(map_keys(headers), array({headers}))), ',') AS platform_headers",
        "body",
    )


def page_facts(pages: DataFrame) -> DataFrame:
    """Crawled pages → one fact row per page; the body does not survive this step.

    Signals that need raw markup are taken on the JVM side before the parse pass. Write
    the result to a table when several jobs read it, so that bodies are parsed once.
    """
    return parse_documents(raw_facts(pages), "body")


def parse_documents(docs: DataFrame, body: str) -> DataFrame:
    """The same parse pass for any table: every other column is passed through."""
    renamed = docs.withColumnRenamed(body, "body")  # the parse pass looks for this name
    passed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in renamed.schema if f.name != "body")
    return renamed.mapInArrow(_parse_batches, f"{passed}, {FACT_DDL}")
