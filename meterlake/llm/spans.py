"""Places of pattern matches inside texts, in code points, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spans are added up in chunks of this many, so that long arrays are not copied once per match.
CHUNK = 256

_SPANS = "array<struct<start:bigint,end:bigint,hit:string>>"


def quoted(regex: str) -> str:
    """A SQL string literal."""
    return "'" + regex.replace("\\", "\\\\").replace("'", "\\'") + "'"


def found(text: str, regex: str, only_if: str = "true") -> Column:
    """All leftmost, non-overlapping matches; an empty array where ``only_if`` does not hold."""
    return F.expr(
        f"CASE WHEN {only_if} THEN regexp_extract_all({text}, {quoted(regex)}, 0) ELSE CAST(array() AS array<string>) END"
    )


def located(text: str, hits: str, regex: str) -> Column:
    """Start, end (exclusive) and text of each match in ``hits``, the result of ``found``.

    What lies between the matches comes from splitting the text by the same pattern; lengths of
    pieces and matches add up to places.
    """
    step = (
        "(a, x) -> named_struct('at', a.at + x.gap + char_length(x.hit), 'spans', array_append(a.spans, "
        "named_struct('start', a.at + x.gap, 'end', a.at + x.gap + char_length(x.hit), 'hit', x.hit)))"
    )
    zero = f"named_struct('at', 0L, 'spans', CAST(array() AS {_SPANS}))"
    pairs = (
        f"zip_with({hits}, slice(split({text}, {quoted(regex)}, -1), 1, size({hits})), "
        "(h, g) -> named_struct('gap', CAST(char_length(g) AS bigint), 'hit', h))"
    )
    chunks = (
        f"transform(array({pairs}), p -> transform(transform(sequence(0, (size(p) - 1) DIV {CHUNK}), "
        f"i -> slice(p, i * {CHUNK} + 1, {CHUNK})), c -> aggregate(c, {zero}, {step})))[0]"
    )
    joined = (
        f"aggregate({chunks}, named_struct('at', 0L, 'out', CAST(array() AS array<{_SPANS}>)), "
        "(a, l) -> named_struct('at', a.at + l.at, 'out', array_append(a.out, transform(l.spans, "
        "s -> named_struct('start', s.start + a.at, 'end', s.end + a.at, 'hit', s.hit)))), a -> flatten(a.out))"
    )
    return F.expr(f"CASE WHEN size({hits}) > 0 THEN {joined} ELSE CAST(array() AS {_SPANS}) END")


def luhn(digits: str) -> str:
    """SQL: whether a string of digits passes the Luhn check."""
    value = f"CAST(substring({digits}, char_length({digits}) - i, 1) AS int)"
    return (
        f"(aggregate(sequence(0, char_length({digits}) - 1), 0, (acc, i) -> acc + CASE WHEN i % 2 = 0 THEN {value} "
        f"WHEN {value} >= 5 THEN 2 * {value} - 9 ELSE 2 * {value} END) % 10 = 0)"
    )


def labelled(kind: str, order: int, spans: str, keep: str = "true") -> str:
    """SQL: the spans (``s`` in ``keep``) with their kind and its place in the listing."""
    return (
        f"transform(filter({spans}, s -> {keep}), s -> named_struct('start', s.start, 'rank', {order}, "
        f"'end', s.end, 'kind', '{kind}', 'hit', s.hit))"
    )


def listing(spans: str) -> str:
    """SQL: ``kind:start:end`` of each span, comma-joined."""
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
