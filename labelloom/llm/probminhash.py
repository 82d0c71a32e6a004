"""Near-duplicates by ProbMinHash, banding and verification.

A text is the multiset of its five-word shingles. Two texts are linked when the probability Jaccard index of their
shingle counts (see ``prob_jaccard``; the plain index where no shingle repeats) is 0.8 or more.

ProbMinHash lets every shingle arrive in a Poisson process with its count as rate, each arrival at a random component
of the signature; the first to reach a component is its entry. Arrivals later than a bound that all components have
been reached by cannot matter, so they are never drawn; a text whose components are not all reached by then gets a
later bound. Entries agree with the probability Jaccard index of the counts, which is never below the weighted one (sum
of minima by sum of maxima).

Texts of equal words are classes from the start, and only one of each goes on. Then:

1. Banding (40 bands of 5: a pair at 0.8 is missed with probability 1e-7). In every bucket the member that meets most
   others, the hub, is compared with the rest, so a bucket costs as many pairs as it has members. Links make components.
2. What is left are pairs of one bucket in different components. In buckets of at most ``SMALL`` members all of them
   are compared. In larger ones members are told apart by what they differ in from their hub, which leaves out all they
   have in common: see ``differing_pairs``. Both find every pair whose weighted index reaches the threshold, so every link of
   texts without repeated shingles; the first is merely cheaper for few members.
3. Where a shingle repeats, the weighted index may be below the threshold and the probability index not. So in every
   bucket pairs with such a text are compared too, unless their shares of shingles are too far apart or, in larger
   buckets, too few of their common shingles differ in number: see ``pairs_with_repeats``.
4. Components of all links are the classes. Pairs inside a component are never listed.

Pairs are dropped early by parity bitmaps: every element flips one of 512 bits, so two bitmaps differ in at most as
many bits as the sets do in elements. Pairs of step 3 have other bounds: entries agree no more often than the total
variation of the shares allows, so shares that differ by more than 2 * (1 - t) in all are no link, and sums of shares
over bins differ by no more than the shares. Every other pair is verified on its whole shingle multisets.

Defined cases: a null text is empty; texts without any word are classes by equality of the text; a text of fewer than
five words is one shingle; repeated rows of one id are one document; rows without an id are left out; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm import shingles
from labelloom.llm.common import connected_components
from labelloom.session import ship_package, stage

THRESHOLD = 0.8
BANDS, ROWS = 40, 5
SMALL = 4
ELEMENT_BYTES = 5
MARKS = 8
BINS = 64
EVEN = 0.02
COUNTS = ("lacked", "first", "first_even")
# Bytes of packed sets that a task takes apart at once.
PAIR_BYTES = 2_000_000
_MARK = "struct<size:int," + ",".join(f"b{i}:bigint" for i in range(MARKS)) + ">"


def multisets(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements (40 bits) of every text in ascending order, their counts, and every text's bounds."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    keys, counts = np.unique((owner << np.uint64(40)) | (hashes >> np.uint64(24)), return_counts=True)
    ends = np.searchsorted(keys >> np.uint64(40), np.arange(len(bounds), dtype=np.uint64))
    return keys & np.uint64((1 << 40) - 1), counts, ends


def _uniform(element: np.ndarray, arrival: int, salt: int) -> np.ndarray:
    return shingles.mix(element * np.uint64(0x9E3779B97F4A7C15) + np.uint64((arrival << 8) + salt))


def prob_minhash(elements: np.ndarray, weights: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """A row of ``m`` entries per text; rows of texts without elements are zero."""
    n = len(bounds) - 1
    signature = np.zeros((n, m), dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    total = np.bincount(owner, weights, minlength=n)
    pending = total > 0
    bound = np.where(pending, m / np.maximum(total, 1) * (np.log(m) + 4), 0)
    while pending.any():
        live = np.flatnonzero(pending[owner])
        who, element, rate = owner[live], elements[live], weights[live].astype(np.float64)
        time, arrival = np.zeros(len(live)), 0
        firsts = np.full(n * m, np.inf)
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(who):
            drawn = (_uniform(element, arrival, 1) >> np.uint64(11)).astype(np.float64) + 1
            time = time - np.log(drawn * 2.0**-53) / rate
            early = time < bound[who]
            who, element, rate, time = who[early], element[early], rate[early], time[early]
            place = who * m + (_uniform(element, arrival, 2) % np.uint64(m)).astype(np.int64)
            np.minimum.at(firsts, place, time)
            met.append((place, time, element))
            arrival += 1
        flat = signature.reshape(-1)
        for place, when, element in met:
            first = firsts[place] == when
            flat[place[first]] = element[first]
        missing = np.isinf(firsts.reshape(n, m)).any(axis=1) & pending
        bound[missing] *= 2
        pending = missing
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; keys of different bands do not meet."""
    cut = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), cut.shape[:2]).copy()
    for i in range(rows):
        out = shingles.mix(out + cut[:, :, i])
    return out.view(np.int64)


def occurrences(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multisets as sets: the second and later occurrences of an element are elements of their own."""
    elements, counts, ends = multisets(hashes, bounds)
    again = np.repeat(elements, counts)
    first = np.cumsum(counts) - counts
    nth = np.arange(len(again)) - np.repeat(first, counts)
    more = nth > 0
    again[more] = shingles.mix(again[more] + (nth[more].astype(np.uint64) << np.uint64(40))) >> np.uint64(24)
    return again, np.concatenate([[0], np.cumsum(counts)])[ends]


def parity_bits(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``MARKS`` 64-bit words per text: bit positions that an odd number of its elements has."""
    n, bits = len(bounds) - 1, 64 * MARKS
    owner = np.repeat(np.arange(n), np.diff(bounds))
    place = (shingles.mix(elements) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(owner * bits + place, minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(odd, axis=1, bitorder="little").view("<i8")


def can_meet(left: str, right: str, threshold: float) -> Column:
    """Whether two mark columns allow the threshold: differing bits against the elements that may differ."""
    c = (1 - threshold) / (1 + threshold)
    differ = sum(F.bit_count(F.col(f"{left}.b{i}").bitwiseXOR(F.col(f"{right}.b{i}"))) for i in range(MARKS))
    return differ <= c * (F.col(f"{left}.size") + F.col(f"{right}.size")) + 1e-9


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(len(a) + len(b) - common, 1)


def prob_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum over common elements d of 1 / sum over all e of max(wa[e] / wa[d], wb[e] / wb[d])."""
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    # e takes the first branch where wa[e] / wb[e] >= wa[d] / wb[d]; elements of one side only sort to the ends.
    ca, cb = wa[ia].astype(np.float64), wb[ib].astype(np.float64)
    order = np.argsort(ca / cb, kind="stable")
    ca, cb = ca[order], cb[order]
    ratio = ca / cb
    from_first = np.searchsorted(ratio, ratio, side="left")
    above = np.concatenate([np.cumsum(ca[::-1])[::-1], [0.0]])[from_first] + wa.sum() - ca.sum()
    below = np.concatenate([[0.0], np.cumsum(cb)])[from_first] + wb.sum() - cb.sum()
    return float((1 / (above / ca + below / cb)).sum())


def counted(elements: np.ndarray, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct elements and their counts; no weights where all counts are one."""
    return elements, np.frombuffer(weights, "<u4").astype(np.int64) if weights else np.ones(len(elements), dtype=np.int64)


def likeness(a: np.ndarray, wa: bytes, b: np.ndarray, wb: bytes) -> float:
    """The probability Jaccard index from distinct elements and the weights."""
    return prob_jaccard(*counted(a, wa), *counted(b, wb)) if wa or wb else jaccard(a, b)


def binned_shares(elements: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``BINS`` sums of signed shares of the counts per text."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    mixed = shingles.mix(elements)
    share = counts / np.maximum(np.bincount(owner, counts, minlength=n), 1)[owner]
    signed_share = np.where(mixed >> np.uint64(63), share, -share)
    place = owner * BINS + (mixed % np.uint64(BINS)).astype(np.int64)
    return np.bincount(place, signed_share, minlength=n * BINS).astype(np.float32)


def shares_can_meet(left: str, right: str, threshold: float) -> Column:
    """Whether two columns of binned shares allow the threshold."""
    apart = F.zip_with(left, right, lambda x, y: F.abs(x - y))
    return F.aggregate(apart, F.lit(0.0), lambda t, x: t + x) <= 2 * (1 - threshold) + 1e-4


def pack_elements(elements: np.ndarray) -> bytes:
    return elements.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ELEMENT_BYTES].tobytes()


def unpack_elements(data: bytes) -> np.ndarray:
    short = np.frombuffer(data, np.uint8).reshape(-1, ELEMENT_BYTES)
    out = np.zeros((len(short), 8), dtype=np.uint8)
    out[:, :ELEMENT_BYTES] = short
    return out.view("<u8").reshape(-1)


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, copy_key, bands)``: texts of equal words share ``copy_key``; texts without words have no bands."""

    def run(batches):
        import xxhash

        from labelloom.llm import probminhash as p
        from labelloom.llm import shingles as s

        for batch in batches:
            for at, texts in s.slices(batch.column("text"), 2_000_000):
                words, bounds = s.word_hashes(texts)
                hashes, places = s.shingle_hashes(words, bounds)
                elements, counts, ends = p.multisets(hashes, places)
                keys = p.band_keys(p.prob_minhash(elements, counts, ends, bands * rows), bands, rows)
                copies = [
                    xxhash.xxh3_128_digest(words[a:b].tobytes() if b > a else text.as_buffer(), 0 if b > a else 1)
                    for a, b, text in zip(bounds, bounds[1:], texts)
                ]
                filled = np.diff(ends) > 0
                steps = np.concatenate([[0], np.cumsum(np.where(filled, bands, 0))])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(at, len(texts)),
                        "copy_key": pa.array(copies, pa.binary()),
                        "bands": pa.ListArray.from_arrays(pa.array(steps, pa.int32()), pa.array(keys[filled].reshape(-1))),
                    }
                )

    return docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL").mapInArrow(
        run, "doc_id long, copy_key binary, bands array<long>"
    )


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``(doc_id, elements, weights, mark, shares)``: distinct shingles, packed, counts where one is above 1, the number
    and parity bits of all occurrences, and the binned shares."""

    def run(batches):
        from labelloom.llm import probminhash as p
        from labelloom.llm import shingles as s

        for batch in batches:
            for at, texts in s.slices(batch.column("text"), 2_000_000):
                hashes, places = s.shingle_hashes(*s.word_hashes(texts))
                elements, ends = p.occurrences(hashes, places)
                distinct, counts, cuts = p.multisets(hashes, places)
                shares = p.binned_shares(distinct, counts, cuts)
                of = [counts[a:b] for a, b in zip(cuts.tolist(), cuts.tolist()[1:])]
                bits = p.parity_bits(elements, ends)
                mark = {"size": pa.array(np.diff(ends), pa.int32())} | {
                    f"b{i}": pa.array(bits[:, i], pa.int64()) for i in range(p.MARKS)
                }
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(at, len(texts)),
                        "elements": pa.array([p.pack_elements(distinct[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        "weights": pa.array([c.astype("<u4").tobytes() if (c > 1).any() else b"" for c in of], pa.binary()),
                        "mark": pa.StructArray.from_arrays(list(mark.values()), list(mark)),
                        "shares": pa.ListArray.from_arrays(
                            pa.array(np.arange(len(texts) + 1) * p.BINS, pa.int32()), pa.array(shares, pa.float32())
                        ),
                    }
                )

    return docs.mapInArrow(run, f"doc_id long, elements binary, weights binary, mark {_MARK}, shares array<float>")


def _with_sets(pairs: DataFrame, sets: DataFrame, left: str, right: str) -> DataFrame:
    side = lambda name, to: sets.select(
        F.col("doc_id").alias(name), F.col("elements").alias(f"e{to}"), F.col("weights").alias(f"w{to}")
    )
    return pairs.join(side(left, "a"), left).join(side(right, "b"), right)


def portions(batch: pa.RecordBatch, most: int = PAIR_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's pairs with about ``most`` bytes of sets, ``ea`` and ``eb``."""
    sizes = (pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("ea", "eb"))
    ends = np.cumsum(sum(sizes).astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def verified(pairs: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(a, b)`` of the pairs whose likeness reaches the threshold."""

    def run(batches):
        from labelloom.llm import probminhash as p

        for batch in chain.from_iterable(map(p.portions, batches)):
            both = zip(*(batch.column(c).to_pylist() for c in ("ea", "wa", "eb", "wb")))
            keep = [
                p.likeness(p.unpack_elements(a), wa, p.unpack_elements(b), wb) >= threshold - 1e-12 for a, wa, b, wb in both
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _with_sets(pairs, sets, "a", "b").select("a", "b", "ea", "wa", "eb", "wb").mapInArrow(run, "a long, b long")


def differences(
    hub: np.ndarray, in_hub: np.ndarray, text: np.ndarray, in_text: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int, tuple[float, float, float], np.ndarray]:
    """What a text has more or less of than its hub, from distinct elements and counts of both.

    The elements whose counts differ, those that the hub lacks first and then by value, an order that all texts of a hub
    share; by how much; how many the hub lacks; three shares of the text: of elements that both have in different numbers, of elements that the hub lacks, and the greatest of
    those under one bit; and the bits of those.
    """
    common, at_hub, at_text = np.intersect1d(hub, text, assume_unique=True, return_indices=True)
    more = in_text[at_text] - in_hub[at_hub]
    uneven = more != 0
    lost, new = np.ones(len(hub), dtype=bool), np.ones(len(text), dtype=bool)
    lost[at_hub] = False
    new[at_text] = False
    held = np.concatenate([hub[lost], common[uneven]])
    order = np.argsort(held)
    elements = np.concatenate([text[new], held[order]])
    amounts = np.concatenate([in_text[new], np.concatenate([in_hub[lost], np.abs(more[uneven])])[order]])
    bits = 64 * MARKS
    total = max(int(in_text.sum()), 1)
    place = (shingles.mix(text[new]) % np.uint64(bits)).astype(np.int64)
    mass = np.bincount(place, in_text[new], minlength=bits) / total
    shares = (float(in_text[at_text][uneven].sum() / total), float(mass.sum()), float(mass.max()))
    return elements, amounts, int(new.sum()), shares, np.packbits(mass > 0, bitorder="little").view("<i8")


def leading(amounts: np.ndarray, size: int, hub_size: int, likeness: float, threshold: float, least: float) -> int:
    """How many of a text's first differences hold one that any text to be linked must share: see ``differing_pairs``."""
    most = likeness + 1 - threshold
    most = min(most, threshold if likeness >= threshold - 1e-12 else 1.0)
    c, wide = ((1 - t) / (1 + t) for t in (most, least))
    other = least * size if c >= wide else size / least
    d = int(amounts.sum())
    overlap = (d - wide * size + max(c * hub_size + (c - wide) * other, -wide * hub_size)) / 2
    return int((d - np.cumsum(amounts) + amounts >= max(overlap - 1e-6, 0.5)).sum())


def compared(stars: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every ``(hub, doc_id, big)`` with its ``likeness``, ``linked``, the sizes of both sides, and, for ``big`` pairs,
    the ``differences`` of ``doc_id``: ``delta`` of its elements and their amounts, the number ``lacked`` by the hub,
    three shares and bits, and how many differences are ``leading`` for the threshold and for ``EVEN`` texts."""

    def run(batches):
        from labelloom.llm import probminhash as p

        leasts = threshold, threshold - 2 * p.EVEN
        for batch in chain.from_iterable(map(p.portions, batches)):
            columns = [batch.column(c).to_pylist() for c in ("big", "ea", "wa", "eb", "wb")]
            found, deltas, amounts, ends, counts, shares, news = [], [], [], [0], [], [], []
            for big, ea, wa, eb, wb in zip(*columns):
                a, b = p.unpack_elements(ea), p.unpack_elements(eb)
                like = p.likeness(a, wa, b, wb)
                (a, ca), (b, cb) = p.counted(a, wa), p.counted(b, wb)
                found.append((like, int(ca.sum()), int(cb.sum())))
                if big:
                    delta, amount, new, share, bits = p.differences(a, ca, b, cb)
                    first, even = (p.leading(amount, found[-1][2], found[-1][1], like, threshold, t) for t in leasts)
                    count = new, first, even
                    deltas.append(delta.astype(np.int64))
                    amounts.append(amount.astype(np.int32))
                else:
                    delta, count, share, bits = [], (0,) * 3, (0.0,) * 3, np.zeros(p.MARKS, dtype=np.int64)
                ends.append(ends[-1] + len(delta))
                counts.append(count)
                shares.append(share)
                news.append(bits)
            flat = [np.concatenate([np.empty(0, t), *x]) for x, t in ((deltas, np.int64), (amounts, np.int32))]
            pieces = pa.StructArray.from_arrays([pa.array(flat[0]), pa.array(flat[1])], ["element", "amount"])
            bits = np.array(news, dtype=np.int64).reshape(-1, p.MARKS)
            yield pa.RecordBatch.from_pydict(
                {
                    "hub": batch.column("hub"),
                    "doc_id": batch.column("doc_id"),
                    "big": batch.column("big"),
                    "likeness": pa.array([x for x, _, _ in found], pa.float64()),
                    "linked": pa.array([x >= threshold - 1e-12 for x, _, _ in found], pa.bool_()),
                    "hub_size": pa.array([x for _, x, _ in found], pa.int32()),
                    "size": pa.array([x for _, _, x in found], pa.int32()),
                    "delta": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces),
                }
                | {name: pa.array([x[i] for x in counts], pa.int32()) for i, name in enumerate(p.COUNTS)}
                | {name: pa.array([x[i] for x in shares], pa.float64()) for i, name in enumerate(("uneven", "fresh", "top"))}
                | {f"f{i}": pa.array(bits[:, i], pa.int64()) for i in range(p.MARKS)}
            )

    joined = _with_sets(stars, sets, "hub", "doc_id")
    return joined.select("hub", "doc_id", "big", "ea", "wa", "eb", "wb").mapInArrow(
        run,
        "hub long, doc_id long, big boolean, likeness double, linked boolean, hub_size int, size int, "
        f"delta array<struct<element:bigint,amount:int>>, {' int, '.join(COUNTS)} int, "
        "uneven double, fresh double, top double, " + ",".join(f"f{i} long" for i in range(MARKS)),
    )


def apart_from_hub(judged: DataFrame, components: DataFrame) -> DataFrame:
    """The ``big`` rows with their ``component``, of hubs whose members are in several components."""
    inside = (
        judged.where("big")
        .join(components.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )
    several = inside.groupBy("hub").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return inside.join(several.select("hub"), "hub")


def uneven_can_meet(left: str, right: str, threshold: float) -> Column:
    """Whether two texts of one hub can have a probability index of the threshold, of which one repeats shingles.

    The index is a sum over common elements. Those of equal counts add up to at most the weighted index, which the
    parity bits bound; every other adds at most the smaller of its shares. An element that two texts have in different
    numbers has not the hub's number in one of them (``uneven``), or the hub lacks it: then it sets a bit of both, and
    no bit stands for more than ``top``. Besides, 1 - index is a metric, so likenesses to the hub bound it too.
    """
    x, y = (lambda name: F.col(f"{left}.{name}")), (lambda name: F.col(f"{right}.{name}"))
    differ = sum(F.bit_count(x(f"b{i}").bitwiseXOR(y(f"b{i}"))) for i in range(MARKS))
    met = sum(F.bit_count(x(f"f{i}").bitwiseAND(y(f"f{i}"))) for i in range(MARKS))
    size = x("size") + y("size")
    new = F.least(x("fresh"), y("fresh"), met * F.least(x("top"), y("top")))
    return (
        (x("repeats") | y("repeats"))
        & (F.abs(x("likeness") - y("likeness")) <= 1 - threshold + 1e-9)
        & ((size - differ) / (size + differ) + x("uneven") + y("uneven") + new >= threshold - 1e-9)
        & shares_can_meet(f"{left}.shares", f"{right}.shares", threshold)
    )


def differing_pairs(inside: DataFrame, marks: DataFrame, may_link: Column, first: str = "first") -> DataFrame:
    """``(a, b)``: all pairs of one hub and different components whose weighted index reaches ``least`` and whose
    probability index reaches the threshold, if for their columns ``mx`` and ``mark`` ``may_link`` holds, from their
    ``leading`` differences; ``marks`` are ``(hub, doc_id, mark)``. The weighted index is never above the other.

    With sizes s and differences D to the hub (sums of amounts), two multisets differ in at least D1 + D2 - 2 * o
    places, o the sum of the smaller amounts of the deltas' common elements, and they reach an index t if they differ in
    at most c(t) * (s1 + s2), c(t) = (1 - t) / (1 + t). So o is at least (D1 + D2 - c(least) * (s1 + s2)) / 2. 1 - index
    is a metric: if 1 has the likeness l to the hub, 2 has at most l + 1 - threshold, and less than the threshold if 1
    is linked with the hub, as only one of the two can be. That is a bound of D2 from below by s2, and s2 lies between
    least * s1 and s1 / least: what o must reach follows from 1 alone. Both deltas are in one order, so the first common
    element comes, in each, before less is left than o must reach, and only these leading elements are joined. What the
    hub lacks comes first: independent changes of a text meet nobody there, while what they take out of the hub often
    is the same.
    """
    rows = inside.select("hub", "doc_id", "component", "linked", F.explode(F.slice("delta", F.lit(1), F.col(first))).alias("e"))
    rows = rows.select("hub", "doc_id", "component", "linked", F.col("e.element").alias("element"))
    shared = rows.groupBy("hub", "element").agg(
        (F.min("component") < F.max("component")).alias("torn"), F.bool_and("linked").alias("near")
    )
    known = rows.join(shared.where("torn AND NOT near").select("hub", "element"), ["hub", "element"])
    marked = known.join(marks, ["hub", "doc_id"]).select("hub", "element", "doc_id", "component", "mark", "linked")
    marked = stage(marked, "torn-differences")  # both sides of the join below, which would each look for them
    far = marked.where("NOT linked").drop("linked")
    other = marked.drop("linked").toDF("h", "e", "x", "cx", "mx")
    same = (F.col("hub") == F.col("h")) & (F.col("element") == F.col("e"))
    met = other.join(far, same & (F.col("cx") != F.col("component")) & may_link)
    return met.select(F.least("x", "doc_id").alias("a"), F.greatest("x", "doc_id").alias("b")).distinct()


def pairs_by_numbers(inside: DataFrame, marks: DataFrame, may_link: Column) -> DataFrame:
    """``(a, b)``: pairs of one hub and different components that have an element in different numbers that the hub
    lacks, and for whose columns ``mx`` and ``mark`` ``may_link`` holds."""
    new = inside.select("hub", "doc_id", "component", F.inline(F.slice("delta", F.lit(1), F.col("lacked"))))
    differ = new.groupBy("hub", "element").agg(
        (F.min("component") < F.max("component")).alias("torn"), (F.min("amount") < F.max("amount")).alias("numbers")
    )
    rows = new.join(differ.where("torn AND numbers").select("hub", "element"), ["hub", "element"])
    rows = rows.select("hub", "element", "doc_id", "component", "amount").join(marks, ["hub", "doc_id"])
    other = rows.toDF("h", "x", "e", "cx", "n", "mx")
    same = (F.col("hub") == F.col("h")) & (F.col("element") == F.col("e")) & (F.col("amount") < F.col("n"))
    met = rows.join(other, same & (F.col("cx") != F.col("component")) & may_link)
    return met.select(F.least("x", "doc_id").alias("a"), F.greatest("x", "doc_id").alias("b")).distinct()


def pairs_with_repeats(inside: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(a, b)``: all pairs of one hub and different components whose probability index can reach the threshold and of
    which one text repeats shingles.

    Most texts hold hardly any element in another number than their hub, at most a share of ``EVEN``. Two of these
    are as like by the weighted index as by the other, but for twice that share, unless they have an element in
    different numbers that the hub lacks. Both kinds of pairs are found by joins on elements; only texts that have
    more in other numbers are compared with all members of their hub.
    """
    repeating = sets.select("doc_id", (F.length("weights") > 0).alias("repeats"), "shares", "mark")
    measured = ["likeness", "uneven", "fresh", "top", *[f"f{i}" for i in range(MARKS)]]
    members = inside.join(repeating, "doc_id")
    hubs = members.groupBy("hub").agg(F.bool_or("repeats").alias("any"), F.max("uneven").alias("most")).where("any")
    rows = members.join(hubs.select("hub", "most"), "hub").withColumn("mark", F.struct("repeats", "shares", "mark.*", *measured))
    rows = stage(rows.drop("repeats", "shares", *measured[2:]), "hubs-with-repeats")
    marks = rows.select("hub", "doc_id", "mark")
    even = rows.where(F.col("uneven") <= EVEN)
    may_link = uneven_can_meet("mx", "mark", threshold)
    odd = (F.col("mx.uneven") > EVEN) | (F.col("mark.uneven") > EVEN)
    drifted = rows.where(F.col("most") > EVEN).select(F.col("hub").alias("key"), "doc_id", "component", "mark")
    return (
        stage(differing_pairs(even, marks, may_link, "first_even"), "even-pairs")
        .union(stage(pairs_by_numbers(even, marks, may_link), "pairs-by-numbers"))
        .union(stage(cross_pairs(drifted, odd & may_link), "drifted-pairs"))
    )


def cross_pairs(rows: DataFrame, may_link) -> DataFrame:
    """``(a, b)``, distinct: members of one bucket in different components for whose columns ``mx`` and ``mark``
    ``may_link`` holds, from ``(key, doc_id, component, mark)``.

    Of such two at least one is outside the bucket's largest component, so only those are joined with all members: a
    bucket that is one component costs nothing.
    """
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = (
        sizes.groupBy("key")
        .agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select(F.col("key").alias("k"), "main")
    )
    strays = rows.join(largest, (F.col("key") == F.col("k")) & (F.col("component") != F.col("main"))).select(
        "k", F.col("doc_id").alias("x"), F.col("component").alias("cx"), F.col("mark").alias("mx")
    )
    apart = (F.col("k") == F.col("key")) & (F.col("cx") != F.col("component"))
    met = strays.join(rows, apart & may_link)
    return met.select(F.least("x", "doc_id").alias("a"), F.greatest("x", "doc_id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, small: int = SMALL) -> DataFrame:
    """``(doc_id, class_id)`` per document; a class is named by its least id."""
    ship_package(docs.sparkSession)
    features = stage(signed(docs), "probminhash")
    copies = features.groupBy("copy_key").agg(F.min("doc_id").alias("rep"))
    rows = (
        features.join(copies, "copy_key")
        .where("doc_id = rep")
        .select("doc_id", F.explode("bands").alias("key"))
    )
    buckets = rows.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    crowded = stage(rows.join(buckets.select("key"), "key").distinct(), "crowded-buckets")
    ids = crowded.select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id", "left_semi")
    sets = stage(shingle_sets(texts).dropDuplicates(["doc_id"]), "shingle-sets")

    # Every kind of pairs is a table of its own: in one plan the driver would hold the exchanges of all of them at once.
    sized = crowded.groupBy("key").agg(F.count("*").alias("n"))
    members = stage(crowded.join(sized, "key"), "bucket-members")
    degree = members.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    hubs = members.join(degree, "doc_id").groupBy("key").agg(F.max_by("doc_id", F.struct("degree", -F.col("doc_id"))).alias("hub"))
    stars = members.join(hubs, "key").where("doc_id <> hub").groupBy("hub", "doc_id").agg(F.max(F.col("n") > small).alias("big"))
    judged = stage(compared(stars, sets, threshold), "compared-stars")
    components = connected_components(judged.where("linked").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")))

    marks = sets.select("doc_id", "mark")
    named = components.withColumnRenamed("node", "doc_id")
    few = members.where(F.col("n") <= small).join(named, "doc_id", "left").join(marks, "doc_id")
    few = few.select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"), "mark")
    rare = stage(cross_pairs(stage(few, "small-buckets"), can_meet("mx", "mark", threshold)), "rare-pairs")
    repeats = sets.select("doc_id", F.struct((F.length("weights") > 0).alias("repeats"), "shares").alias("mark"))
    # Only small buckets with a text that repeats a shingle and with more than one component; then texts of one hub.
    placed = members.where(F.col("n") <= small).join(named, "doc_id", "left")
    placed = placed.select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    placed = placed.join(repeats.select("doc_id", "mark.repeats"), "doc_id")
    torn = placed.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.bool_or("repeats").alias("any")
    )
    mixed = placed.join(torn.where("any AND lo < hi").select("key"), "key").drop("repeats").join(repeats, "doc_id")
    may_link = (F.col("mx.repeats") | F.col("mark.repeats")) & shares_can_meet("mx.shares", "mark.shares", threshold)
    uneven = stage(cross_pairs(stage(mixed, "buckets-with-repeats"), may_link), "uneven-pairs")
    inside = stage(apart_from_hub(judged, components), "apart-from-hub")
    by_hub = inside.select("hub", "doc_id", "likeness").join(marks, "doc_id")
    by_hub = by_hub.select("hub", "doc_id", F.struct("mark.*", "likeness").alias("mark"))
    near = F.abs(F.col("mx.likeness") - F.col("mark.likeness")) <= 1 - threshold + 1e-9
    apart = stage(differing_pairs(inside, by_hub, near & can_meet("mx", "mark", threshold)), "pairs-apart")
    drifted = pairs_with_repeats(inside, sets, threshold)
    told = judged.select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b"))
    rest = rare.union(apart).union(uneven).union(drifted).distinct().join(told, ["a", "b"], "left_anti")
    more = stage(verified(stage(rest, "cross-pairs"), sets, threshold), "cross-links")
    roots = connected_components(components.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    named = roots.select(F.col("node").alias("rep"), "component")
    membership = features.select("doc_id", "copy_key").join(copies, "copy_key").select("doc_id", "rep").distinct()
    return membership.join(named, "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("class_id"))
