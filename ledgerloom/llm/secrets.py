"""Secrets in texts: fixed shapes, and strings whose sliding-window entropy is that of random characters.

Everything is built-in SQL: a text is cut at the matches of a pattern, and running sums of the lengths give positions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.rows import boxed, field

# The shapes of the base kinds, in the order of the kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6  # characters of the value
ACCESS = r"AKIA[A-Z0-9]{16,}"  # of AKIA[A-Z0-9]+ those with 20 characters or more
HEX = r"[0-9a-f]{24,}"  # of [0-9a-f]+ those with 24 characters or more
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20  # characters
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Bits in a window from which a candidate of a character class is a secret; the first class that holds it counts.
CLASSES = (("[A-Za-z=_+/-]+", 4.05), ("[0-9a-fA-F]+", 3.05), ("[A-Za-z0-9]+", 3.75), ("[A-Za-z0-9_=-]+", 3.85), (".+", 3.95))
#: Candidates that never count: words of one case, numbers, UUIDs, and what says that it is an example.
ALLOWED = (
    r"^[A-Z]?[a-z=_+/-]+$",
    r"^[A-Z=_+/-]+$",
    r"^[0-9=_+/-]+$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|dummy|placeholder|changeme|xxxx",
)
#: Nor do paths: strings of the first shape that begin as the second and do not hold the third.
PATH = (r"^[a-z0-9_/-]+$", r"^/?[a-z0-9_-]+/", "//")
BLOCK = 64  # lengths are summed in blocks and spans compared by blocks, so that a text with many matches stays cheap
STRETCH = 1 << 15  # windows of a candidate that are walked through at once
PACK, BITS = 12, 5  # counts of so many characters, of so many bits each, lie in one number


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often and in whichever lambda it is used.

    The optimizer merges a column that is used once into its user, also into a lambda that runs for every element.
    """
    return F.transform(F.array(value), use)[0]


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """The pattern's matches, which are never empty: an array of ``start, end, value`` (of the group)."""
    total = lambda numbers: F.aggregate(numbers, F.lit(0), lambda a, x: a + x)
    block = lambda i: F.floor(i / BLOCK).cast("int")

    def spans(found: Column, values: Column, steps: Column, before: Column) -> Column:
        def one(v: Column, i: Column) -> Column:
            start = F.get(before, block(i)) + total(F.slice(steps, block(i) * BLOCK + 1, i % BLOCK + 1))
            return let(start, lambda s: F.struct(s.alias("start"), (s + F.length(v)).alias("end"), F.get(values, i).alias("value")))

        return F.transform(found, one)

    def summed(found: Column, values: Column, steps: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), block(F.size(steps) - 1)), lambda b: total(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
        before = lambda sums: F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b)))
        return let(let(blocks, before), lambda x: spans(found, values, steps, x))

    def walked(found: Column, values: Column) -> Column:
        # a step is a match and the gap after it, the first one a gap alone; match i starts after steps 0 to i
        steps = F.transform(F.split(text, pattern, -1), lambda gap, i: F.length(gap) + F.when(i == 0, 0).otherwise(F.length(F.get(found, i - 1))))
        return let(steps, lambda x: summed(found, values, x))

    matches = lambda n: F.regexp_extract_all(text, F.lit(pattern), F.lit(n))
    return let(matches(0), lambda found: let(matches(group), lambda values: walked(found, values)) if group else walked(found, found))


def entropy(value: str) -> str:
    """SQL for the largest Shannon entropy of a window, in bits, of an expression with characters of the alphabet only.

    A window keeps the count of each character, packed into a few numbers, and the sum of c * log2(c) over them; a step adds
    one to the count of the character that enters and takes one from that which leaves, and mends the sum by what these two
    counts say. A long value is walked through in stretches that overlap by a window.
    """
    gain = [(c + 1) * math.log2(c + 1) - (c * math.log2(c) if c else 0.0) for c in range(WINDOW)]
    gains = f"array({', '.join(f'{g!r}D' for g in gain)})"
    packs = [f"w{p}" for p in range(-(-(len(ALPHABET) + 1) // PACK))]
    place = lambda code: f"({BITS} * ({code} % {PACK}))"
    one = lambda code, p: f"if({code} div {PACK} = {p}, shiftleft(1L, {place(code)}), 0L)"
    held = lambda code: f"(shiftright(element_at(array({', '.join(f'acc.{w}' for w in packs)}), cast({code} div {PACK} AS int) + 1), {place(code)}) & {(1 << BITS) - 1})"
    old, new = f"codes[i - {WINDOW}]", "codes[i]"
    gained, lost = f"gains[cast({held(new)} AS int)]", f"if(i < {WINDOW}, 0D, gains[cast({held(old)} AS int) - 1])"
    same = f"(i >= {WINDOW} AND codes[i] = codes[i - {WINDOW}])"
    packed = ", ".join(f"'{w}', acc.{w} + {one(new, p)} - if(i < {WINDOW}, 0L, {one(old, p)})" for p, w in enumerate(packs))
    step = f"named_struct({packed}, 'total', acc.total + if({same}, 0D, {gained} - {lost}), 'least', if(i < {WINDOW}, acc.least, least(acc.least, acc.total)))"
    zero = f"named_struct({', '.join(f"'{w}', 0L" for w in packs)}, 'total', 0D, 'least', 1000D)"
    run = f"aggregate(sequence(0, size(codes) - 1), {zero}, (acc, i) -> {step}, acc -> log2({WINDOW}) - least(acc.least, acc.total) / {WINDOW})"
    codes = f"transform(filter(split(substr(v, n * {STRETCH} + 1, {STRETCH + WINDOW - 1}), ''), c -> c <> ''), c -> instr('{ALPHABET}', c))"
    each = f"transform(array({codes}), codes -> transform(array({gains}), gains -> {run})[0])[0]"
    stretches = f"sequence(0, cast(greatest(length(v) - {WINDOW}, 0) div {STRETCH} AS int))"
    return f"transform(array({value}), v -> array_max(transform({stretches}, n -> {each})))[0]"


def least_entropy(value: Column) -> Column:
    """Bits from which a candidate counts, by its character class; null for one that is allowed."""
    out = F.lit(99.0)
    for shape, bits in reversed(CLASSES):
        out = F.when(value.rlike(f"^{shape}$"), bits).otherwise(out)
    for shape in ALLOWED:
        out = F.when(value.rlike(shape), None).otherwise(out)
    charset, begin, never = PATH
    return F.when(value.rlike(charset) & value.rlike(begin) & ~value.contains(never), None).otherwise(out)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: an array of ``start, kind_no, kind, end`` in order of start, then kind.

    Positions are code points, the end is exclusive. ``assign``, ``access`` and ``hex`` are the leftmost non-overlapping
    matches of their shapes; ``entropy`` spans are candidate strings (runs of at least 20 characters of the alphabet)
    that are not allowed, have a window of their class's entropy or more, and overlap none of the other kinds. Digits
    alone never count, letters alone only if they are of both cases. A null text is empty and has none. A column of the name
    ``secrets`` is replaced, all others stay.
    """
    df = boxed(docs.drop("secrets"), body=F.coalesce(F.col(text), F.lit("")))
    for name, pattern, group in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("strings", CANDIDATE, 0)):
        df = df.withColumn(name, located(F.col("body"), pattern, group))
    spans = lambda name, kind: f"transform({name}, m -> named_struct('start', m.start, 'kind_no', {kind}, 'kind', '{KINDS[kind]}', 'end', m.end))"
    df = df.withColumn("assign", F.filter("assign", lambda m: F.length(m["value"]) >= ASSIGN_LEAST))
    df = df.withColumn("base", F.expr(f"array_sort(concat({spans('assign', 0)}, {spans('access', 1)}, {spans('hex', 2)}))"))
    df = df.withColumn("strings", let(stretches(F.col("base")), lambda x: F.filter("strings", lambda m: ~covered(m, x))))
    df = df.withColumn("strings", F.transform("strings", lambda m: m.withField("least", least_entropy(m["value"]))))
    df = df.withColumn("strings", F.expr("filter(strings, m -> m.least IS NOT NULL)"))
    df = df.withColumn("strings", F.expr(f"filter(strings, m -> {entropy('m.value')} >= m.least)"))
    found = F.expr(f"array_sort(concat(base, {spans('strings', 3)}))")
    return df.select(*[F.col(field(c)).alias(c) for c in docs.columns if c.lower() != "secrets"], found.alias("secrets"))


def stretches(spans: Column) -> Column:
    """Sorted spans in blocks, each with its first start and last end."""

    def one(own: Column) -> Column:
        return F.struct(own.alias("own"), F.get(own, F.lit(0))["start"].alias("start"), F.array_max(F.transform(own, lambda b: b["end"])).alias("end"))

    blocks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(spans) - 1) / BLOCK), F.lit(0)).cast("int"))
    return let(spans, lambda x: F.transform(blocks, lambda n: let(F.slice(x, n * BLOCK + 1, F.lit(BLOCK)), one)))


def covered(span: Column, blocks: Column) -> Column:
    """Whether a span overlaps one of those in the blocks."""
    meets = lambda other: (other["start"] < span["end"]) & (span["start"] < other["end"])
    return F.exists(blocks, lambda s: meets(s) & F.exists(s["own"], meets))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str, mask: str = "[SECRET]") -> Column:
    """The text with every span of ``secrets`` (of a scanned frame) replaced by ``mask``; overlapping spans are one.

    A null text stays null.
    """
    # walking the spans in order keeps the pieces of text between them; upto is the end of what is masked so far
    zero = "named_struct('upto', 0, 'pieces', cast(array() AS array<string>))"
    gap = f"if(s.start >= acc.upto, array(substr({text}, acc.upto + 1, s.start - acc.upto)), cast(array() AS array<string>))"
    step = f"named_struct('upto', greatest(acc.upto, s.end), 'pieces', concat(acc.pieces, {gap}))"
    out = f"aggregate(secrets, {zero}, (acc, s) -> {step}, acc -> array_join(concat(acc.pieces, array(substr({text}, acc.upto + 1))), '{mask}'))"
    return F.when(F.size("secrets") > 0, F.expr(out)).otherwise(F.expr(text))
