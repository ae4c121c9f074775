"""Secret scan: patterns, and sliding-window entropy over candidate strings.

Entropy is taken per character class (hexadecimal; letters of one case among digits;
base64 with lower case, upper case and digits) over a window that slides along a
candidate, and along each run of hexadecimal digits, or of digits and letters of one
case, inside it, so that a name glued to a secret does not hide it. The window's symbol
counts change by the symbol that enters and the one that leaves, and so does the sum
of ``c * log2(c)``, in integers, so that every engine decides alike. Matches of an
allow-list are cut out of candidates, so that windows over them are suppressed and the
parts on both sides are scanned. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of the base kinds, in the order that breaks ties. A match counts if its
# last group has so many characters or more.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# Runs in a candidate that have a class of their own, whatever is around them.
RUNS = tuple(f"[{c}]{{20,}}" for c in ("0-9a-f", "0-9A-F", "0-9a-z", "0-9A-Z"))
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
# Bits of entropy from which a window of a class is suspicious.
THRESHOLDS = {"hex": 3.0, "case": 3.2, "base64": 3.7}
# Parts of candidates that are no secrets: placeholders, counting and repeated characters.
ALLOW = r"(?i)example|placeholder|changeme|0123456789|abcdefgh|x{8,}|(.)\1{7,}"
MASK = "[SECRET]"

UNIT = 1_000_000
SPAN = "struct<start:int,kind:int,end:int,value:string>"


def weights(window: int = WINDOW) -> list[int]:
    """``c * log2(c)`` of the counts 0 to ``window``, in millionths."""
    return [0] + [round(UNIT * c * math.log2(c)) for c in range(1, window + 1)]


def most_sum(bits: float, window: int = WINDOW) -> int:
    """The largest sum of ``c * log2(c)`` of a window with ``bits`` of entropy or more."""
    return math.floor(UNIT * window * (math.log2(window) - bits))


def _located(kind: int, pattern: str, keep: str, group: int | None = None, text: str = "text", start: str = "0") -> str:
    """All matches of a pattern in ``text`` that ``keep`` accepts, with their places,
    counted from ``start``.

    What is between the matches gives the places; ``x`` has the piece before a match
    (``1``), the match (``0``) and its last group (``2``).
    """
    quoted = pattern.replace("'", "\\x27")
    last = f", regexp_extract_all({text}, r'{quoted}', {group})" if group else ""
    return f"""aggregate(
        arrays_zip(regexp_extract_all({text}, r'{quoted}', 0), split({text}, r'{quoted}', -1){last}),
        named_struct('found', cast(array() AS array<{SPAN}>), 'at', {start}),
        (a, x) -> if(x.`0` IS NULL, a, named_struct(
            'found', if({keep}, concat(a.found, array(named_struct('start', a.at + length(x.`1`), 'kind', {kind},
                'end', a.at + length(x.`1`) + length(x.`0`), 'value', x.`0`))), a.found),
            'at', a.at + length(x.`1`) + length(x.`0`))),
        a -> a.found)"""


def _between(pattern: str, window: int) -> str:
    """The pieces of the candidate ``c`` on both sides of the matches of a pattern, of those
    that hold a window.
    """
    return f"""if(NOT c.value RLIKE r'{pattern}', array(c), filter(aggregate(
        arrays_zip(regexp_extract_all(c.value, r'{pattern}', 0), split(c.value, r'{pattern}', -1)),
        named_struct('found', cast(array() AS array<{SPAN}>), 'at', c.start),
        (a, x) -> named_struct(
            'found', concat(a.found, array(named_struct('start', a.at, 'kind', c.kind,
                'end', a.at + length(x.`1`), 'value', x.`1`))),
            'at', a.at + length(x.`1`) + coalesce(length(x.`0`), 0)),
        a -> a.found), p -> length(p.value) >= {window}))"""


def _entropy(window: int) -> str:
    """The suspicious parts of ``candidates`` and of the runs in them, overlapping ones joined."""
    kind = KINDS.index("entropy")
    runs = ", ".join(_located(kind, run, "true", text="c.value", start="c.start") for run in RUNS)
    pieces = f"flatten(transform(candidates, c -> {_between(ALLOW, window)}))"
    parts = f"array_distinct(flatten(transform({pieces}, c -> concat(array(c), {runs}))))"
    table = f"array({', '.join(f'{w}L' for w in weights(window))})"
    hexadecimal = "(c.value RLIKE '^[0-9a-f]+$' OR c.value RLIKE '^[0-9A-F]+$')"
    # Digits on both sides of letters: words with a number before or behind are no secrets.
    case = "((c.value RLIKE '^[0-9a-z]+$' OR c.value RLIKE '^[0-9A-Z]+$') AND c.value RLIKE '[0-9][A-Za-z]+[0-9]')"
    mixed = "(c.value RLIKE '[a-z]' AND c.value RLIKE '[A-Z]' AND c.value RLIKE '[0-9]')"
    most = (
        f"CASE WHEN {hexadecimal} THEN {most_sum(THRESHOLDS['hex'], window)}L"
        f" WHEN {case} THEN {most_sum(THRESHOLDS['case'], window)}L"
        f" WHEN {mixed} THEN {most_sum(THRESHOLDS['base64'], window)}L ELSE -1L END"
    )
    size = len(SYMBOLS)
    # z: symbols ``s`` and largest sum ``t`` of the candidate c; b: state before, e: the
    # symbol that enters, the one that leaves (0: none) and the place after them.
    step = f"""named_struct(
        'counts', transform(b.counts, (n, k) -> n + int(k + 1 = e.enters) - int(k + 1 = e.leaves)),
        'total', b.total + {table}[b.counts[e.enters - 1] + 1] - {table}[b.counts[e.enters - 1]]
            + if(e.leaves = 0, 0L, {table}[b.counts[e.leaves - 1] + int(e.enters = e.leaves) - 1]
                                 - {table}[b.counts[e.leaves - 1] + int(e.enters = e.leaves)]))"""
    moved = f"""aggregate(
        transform(z.s, (x, i) -> named_struct('enters', x, 'leaves', if(i < {window}, 0, z.s[i - {window}]), 'after', i + 1)),
        named_struct('counts', array_repeat(0, {size}), 'total', 0L, 'first', -1, 'last', -1),
        (b, e) -> transform(array({step}), n -> named_struct(
            'counts', n.counts, 'total', n.total,
            'first', if(e.after >= {window} AND n.total <= z.t AND b.first < 0, e.after - {window}, b.first),
            'last', if(e.after >= {window} AND n.total <= z.t, e.after, b.last)))[0],
        b -> named_struct('first', b.first, 'last', b.last))"""
    scanned = f"""transform(
        filter({parts}, c -> {most} >= 0),
        c -> transform(array(named_struct('s', transform(split(c.value, ''), x -> locate(x, '{SYMBOLS}')), 't', {most})),
            z -> transform(array({moved}),
                r -> named_struct('start', c.start + r.first, 'kind', {kind}, 'end', c.start + r.last,
                    'value', substr(c.value, r.first + 1, r.last - r.first))))[0][0])"""
    last = "element_at(done, -1)"
    return f"""aggregate(array_sort(filter({scanned}, r -> r.end > r.start)), cast(array() AS array<{SPAN}>), (done, s) -> if(
        size(done) = 0 OR s.start >= {last}.end, concat(done, array(s)),
        concat(slice(done, 1, size(done) - 1), array(named_struct('start', {last}.start, 'kind', {kind},
            'end', greatest({last}.end, s.end), 'value', concat({last}.value, substr(s.value, {last}.end - s.start + 1)))))))"""


def secrets(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with a column ``spans``: array of ``(start, kind, end, value)``, by start
    and kind, in code points from 0, the end exclusive.

    Kinds 0 to 2 are the patterns (``assign``, ``access``, ``hex``); matches of one
    kind do not overlap and may overlap another kind's. Kind 3 is a suspicious part
    of a candidate or of a run in it, unless it lies within a span of another kind. Null and empty
    texts have none; repeated rows are scanned alike; other columns are passed on
    (a column ``spans`` is replaced).
    """
    quick = "(instr(text, ':') > 0 OR instr(text, '=') > 0)"
    none = f"cast(array() AS array<{SPAN}>)"
    assign = _located(0, ASSIGN, f"length(x.`2`) >= {ASSIGN_LENGTH}", 2)
    # The other two are runs, so that a longer least length keeps the same matches.
    access = _located(1, f"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}", "true")
    hexes = _located(2, f"[0-9a-f]{{{HEX_LENGTH},}}", "true")
    candidates = _located(KINDS.index("entropy"), CANDIDATE, "true")
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    based = rows.select(
        "doc",
        F.expr(
            f"concat(if({quick}, {assign}, {none}), if(instr(text, 'AKIA') > 0, {access}, {none}), {hexes})"
        ).alias("base"),
        F.expr(candidates).alias("candidates"),
    )
    added = based.select("doc", "base", F.expr(_entropy(window)).alias("added"))
    new = "filter(added, s -> NOT exists(base, b -> b.start <= s.start AND s.end <= b.end))"
    return added.select(
        *[F.col("doc")[name].alias(name) for name in docs.columns if name.lower() != "spans"],
        F.expr(f"array_sort(concat(base, {new}))").alias("spans"),
    )


def span_text(spans: Column | str, kinds: int = len(KINDS)) -> Column:
    """``kind:start:end`` of the spans of the first kinds, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    column = spans if isinstance(spans, str) else "spans"
    return F.expr(
        f"array_join(transform(filter({column}, s -> s.kind < {kinds}),"
        f" s -> concat(array({names})[s.kind], ':', s.start, ':', s.end)), ',')"
    )


def masked(docs: DataFrame, window: int = WINDOW, mask: str = MASK) -> DataFrame:
    """``docs`` with each secret of the text replaced by ``mask``; overlapping spans are
    one secret. All rows and columns stay, texts without secrets as they are.
    """
    found = secrets(docs, window)
    text = f"""aggregate(spans, named_struct('out', '', 'at', 0),
        (a, s) -> named_struct(
            'out', if(s.start >= a.at, concat(a.out, substr(text, a.at + 1, s.start - a.at), '{mask}'), a.out),
            'at', greatest(a.at, s.end)),
        a -> concat(a.out, substr(text, a.at + 1)))"""
    return found.withColumn("text", F.expr(f"if(size(spans) = 0, text, {text})")).select(*docs.columns)
