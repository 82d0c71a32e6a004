"""Secret scan with column expressions only.

Base patterns find assignments, access keys and long hex runs. Beyond them, runs of key characters are candidates. Base
spans are cut out of a run, and what is left of it on either side is measured by itself: a window slides over it, the
counts of its characters are carried along by adding the one that enters and removing the one that leaves, and with them
the sum of c * log2(c), from which the Shannon entropy follows. A part is reported when some window reaches the threshold
of its character class and when it is not on the allow-list. Parts of ``WINDOW`` characters and more take a window of that
many; shorter ones of at least ``SHORT_WINDOW`` take that window, its own thresholds and a longer allow-list, because
ordinary compounds of words and numbers are as long. Entropy sums are whole numbers (1e-6 bits), so every engine agrees.

Defined cases: a null or empty text has no spans; positions are code points, ends exclusive; repeated rows are judged
one by one; an empty table gives no rows; other columns pass through unread.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import let

# The base patterns.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 12
# Maximal runs: a shorter one has no longer run inside, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
WINDOW, SHORT_WINDOW = 20, 12
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SCALE = 1_000_000
SUMS = [0] + [round(SCALE * c * log2(c)) for c in range(1, WINDOW + 2)]
BITS = {"entropy_hex": 2.8, "entropy_key": 3.6}
SHORT_BITS = {"entropy_hex": 2.7, "entropy_key": 3.2}
KINDS = ("assign", "access", "hex", *BITS)
# Runs that are no secrets whatever their entropy: numbers, identifiers of known shape, words joined by separators.
ALLOWED = (
    r"^[0-9]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z]+([-_/=+]+[A-Za-z]+)*[-_/=+]*[0-9]{0,6}$",
    r"EXAMPLE",
    r"^([0-9]+[-/_]?)+$",
)
# Among shorter ones also pieces between separators that are words, numbers or both in one change ("19th-century", "UTF8").
ALLOWED_SHORT = (r"^[-_/=+]*([A-Za-z]*[0-9]*|[0-9]+[A-Za-z]+)([-_/=+]+([A-Za-z]*[0-9]*|[0-9]+[A-Za-z]+))*$",)
BLOCK = 256


def largest_sum(bits: float, window: int = WINDOW) -> int:
    """Largest sum of c * log2(c) in a window that still has ``bits`` of entropy."""
    return round(SCALE * window * (log2(window) - bits))


def located(text: Column, pattern: str) -> Column:
    """Array of ``(found, start)`` of the leftmost non-overlapping matches; starts are prefix sums of piece lengths."""

    def places(found):
        gaps = F.split(text, pattern, -1)
        sizes = F.transform(found, lambda m, i: F.char_length(m))
        lengths = F.zip_with(F.transform(gaps, F.char_length), sizes, lambda g, m: g + F.coalesce(m, F.lit(0)))
        total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
        blocks = lambda steps: F.transform(
            F.sequence(F.lit(0), F.floor(F.size(steps) / BLOCK).cast("int")),
            lambda b: total(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))),
        )

        def start(steps, before, m, i):
            b = F.floor(i / BLOCK).cast("int")
            inside = total(F.slice(steps, b * BLOCK + 1, i - b * BLOCK + 1))
            return total(F.slice(before, F.lit(1), b)) + inside - F.char_length(m)

        return let(
            F.struct(lengths.alias("steps"), blocks(lengths).alias("before")),
            lambda v: F.transform(
                found, lambda m, i: F.struct(m.alias("found"), start(v["steps"], v["before"], m, i).alias("start"))
            ),
        )

    return let(
        F.regexp_extract_all(text, F.lit(pattern), 0),
        lambda found: F.when(F.size(found) > 0, places(found)).otherwise(
            F.array().cast("array<struct<found:string,start:int>>")
        ),
    )


def least_window_sum(run: Column, window: Column) -> Column:
    """Least sum of c * log2(c) over all windows of a run, by counts that follow the window."""
    sums = F.array(*[F.lit(s) for s in SUMS])
    at = lambda i: F.instr(F.lit(ALPHABET), F.substring(run, i, F.lit(1)))
    zero = F.array_repeat(F.lit(0), len(ALPHABET) + 1)
    state = F.struct(zero.alias("counts"), F.lit(0).alias("sum"), F.lit(2_000_000_000).alias("least"))

    def slide(s, i):
        entering, leaving = at(i), F.when(i > window, at(i - window)).otherwise(F.lit(0))

        def step(v):
            c_in = F.element_at(s["counts"], v["entering"] + 1)
            added = F.element_at(v["sums"], c_in + 2) - F.element_at(v["sums"], c_in + 1)
            c_out = F.element_at(s["counts"], v["leaving"] + 1) + (v["leaving"] == v["entering"]).cast("int")
            removed = F.when(
                v["leaving"] > 0, F.element_at(v["sums"], c_out + 1) - F.element_at(v["sums"], c_out)
            ).otherwise(F.lit(0))
            total = s["sum"] + added - removed
            counts = F.transform(
                s["counts"],
                lambda c, k: c + (k == v["entering"]).cast("int") - ((k == v["leaving"]) & (k > 0)).cast("int"),
            )
            least = F.when(i >= window, F.least(s["least"], total)).otherwise(s["least"])
            return F.struct(counts.alias("counts"), total.alias("sum"), least.alias("least"))

        return let(F.struct(entering.alias("entering"), leaving.alias("leaving"), sums.alias("sums")), step)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(run)), state, slide, lambda s: s["least"])


def _span(kind: str, m: Column) -> Column:
    return F.struct(
        m["start"].alias("start"),
        (m["start"] + F.char_length(m["found"])).alias("end"),
        F.lit(KINDS.index(kind)).alias("rank"),
        F.lit(kind).alias("kind"),
    )


def _value_length(found: Column) -> Column:
    return F.char_length(F.regexp_extract(found, ASSIGN, 2))


def free_parts(m: Column) -> Column:
    """Parts of a run ``(found, start)`` that no base span covers, in order; spans come in order of their starts."""
    stop = m["start"] + F.char_length(m["found"])
    touching = F.filter("base_spans", lambda b: (b["start"] < stop) & (m["start"] < b["end"]))
    with_part = lambda parts, start, end: F.when(
        start < end, F.concat(parts, F.array(F.struct(start.alias("start"), end.alias("end"))))
    ).otherwise(parts)
    none = F.array().cast("array<struct<start:int,end:int>>")
    parts = F.aggregate(
        touching,
        F.struct(m["start"].alias("reach"), none.alias("parts")),
        lambda a, b: F.struct(
            F.greatest(a["reach"], b["end"]).alias("reach"), with_part(a["parts"], a["reach"], b["start"]).alias("parts")
        ),
        lambda a: with_part(a["parts"], a["reach"], stop),
    )
    cut = F.transform(
        parts,
        lambda p: F.struct(
            F.substring(m["found"], p["start"] - m["start"] + 1, p["end"] - p["start"]).alias("found"), p["start"].alias("start")
        ),
    )
    return F.when(F.size(touching) == 0, F.array(m)).otherwise(cut)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of ``(start, end, rank, kind)`` in order."""
    source = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(located(source, ASSIGN), lambda m: _value_length(m["found"]) >= ASSIGN_VALUE)
    base = F.array_sort(
        F.concat(
            F.transform(assign, lambda m: _span("assign", m)),
            F.transform(located(source, ACCESS), lambda m: _span("access", m)),
            F.transform(located(source, HEX), lambda m: _span("hex", m)),
        )
    )
    with_base = docs.withColumn("base_spans", base)
    mixed = lambda m: m["found"].rlike("[0-9]") & m["found"].rlike("[A-Za-z]")
    listed = lambda m, patterns: m["found"].rlike("|".join(f"(?:{p})" for p in patterns))
    is_long = lambda m: F.char_length(m["found"]) >= WINDOW
    is_hex = lambda m: m["found"].rlike("^[0-9a-fA-F]+$")
    runs = F.filter(located(source, CANDIDATE), mixed)
    candidates = F.filter(
        F.flatten(F.transform(runs, free_parts)),
        lambda m: (F.char_length(m["found"]) >= SHORT_WINDOW)
        & mixed(m)
        & ~listed(m, ALLOWED)
        & (is_long(m) | ~listed(m, ALLOWED_SHORT)),
    )
    limit = lambda m, bits, window: F.when(is_hex(m), F.lit(largest_sum(bits["entropy_hex"], window))).otherwise(
        F.lit(largest_sum(bits["entropy_key"], window))
    )
    secret = F.filter(
        candidates,
        lambda m: least_window_sum(m["found"], F.when(is_long(m), F.lit(WINDOW)).otherwise(F.lit(SHORT_WINDOW)))
        <= F.when(is_long(m), limit(m, BITS, WINDOW)).otherwise(limit(m, SHORT_BITS, SHORT_WINDOW)),
    )
    more = F.transform(
        secret, lambda m: F.when(is_hex(m), _span("entropy_hex", m)).otherwise(_span("entropy_key", m))
    )
    return with_base.withColumn("spans", F.array_sort(F.concat("base_spans", more)))


def shown(spans: Column) -> Column:
    """``kind:start:end`` by start, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(scanned: DataFrame, mark: str = "[secret]", text: str = "text") -> DataFrame:
    """``text`` of scanned rows with every stretch covered by spans replaced by one mark; other columns stay."""
    source = F.col(text)
    reach = lambda spans: F.aggregate(spans, F.lit(-1), lambda a, s: F.greatest(a, s["end"]))
    # Spans come in order, so one opens a stretch when it starts after all ends before it.
    opening = F.filter("spans", lambda s, i: s["start"] > reach(F.slice("spans", F.lit(1), i)))
    starts = F.transform(opening, lambda s: s["start"])

    def stretches(at):
        """Starts with the end of the last span before the next start."""
        return F.transform(
            at,
            lambda start, i: F.struct(
                start.alias("start"),
                reach(F.filter("spans", lambda s: s["start"] < F.coalesce(F.get(at, i + 1), F.lit(2**31 - 1)))).alias("end"),
            ),
        )

    def rebuilt(cut):
        pieces = F.transform(
            cut,
            lambda c, i: F.concat(
                F.substring(
                    source,
                    F.when(i == 0, F.lit(1)).otherwise(F.get(cut, i - 1)["end"] + 1),
                    c["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(cut, i - 1)["end"]),
                ),
                F.lit(mark),
            ),
        )
        tail = F.substring(source, F.element_at(cut, -1)["end"] + 1, F.char_length(source))
        return F.concat(F.array_join(pieces, ""), tail)

    cleaned = F.when(F.size("spans") > 0, let(starts, lambda at: let(stretches(at), rebuilt))).otherwise(source)
    return scanned.withColumn(text, cleaned)
