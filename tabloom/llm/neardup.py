"""Near-duplicate documents: Order MinHash candidates, verified by banded alignment of words.

The k-mers of a document are its runs of four words, each labelled with how often it has occurred before. A sketch
entry takes the two labelled k-mers with the smallest hash, in the order of the text, so documents share an
entry with a probability that follows their edit similarity, not only their sets. Documents that share an entry
are candidates; they are linked if the edit similarity of their words (1 - distance / longer length) is 0.8 or
more. Entries and k-mer length are set for a recall of 0.98 at that threshold if changes are scattered at random:
with 64 entries, of 400 simulated pairs of 300 distinct words each, all became candidates at an edit similarity of
0.82 or more, and 0.99 of them at 0.80. Candidates are not exact: evenly spaced changes, which leave fewer k-mers,
and texts of a few words can be missed.

1. Texts are compared once: exact copies are collapsed by digest, whatever their number, and distinct texts are
   numbered. Only entries that several texts have are kept, with their texts' numbers.
2. Every text that shares an entry is compared with the smallest text of that entry, if their lengths allow a
   link. In groups of copies this already links nearly all, with one comparison each.
3. What shares an entry but is not yet in one class is compared within the entry, among texts whose lengths allow a
   link, in blocks of bounded size: the entry's largest class against all others, and these among themselves. A pair
   is compared in the first entry that both have and only until their classes meet; pairs that have too few words in
   common are skipped. So no link between classes is lost, and a large group costs the square of its size only where
   its texts really differ.

Defined cases: a null text counts as empty; equal texts, empty ones too, are one class; texts of fewer than four
words have one k-mer, all their words; rows with equal or null keys are rows of their own, and exactly one row
of a class is kept, that with the smallest key (nulls last); an empty table gives an empty result; texts of any length
are read whole; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.alignment import distance_within
from tabloom.llm.batches import texts_of
from tabloom.llm.components import components, joined_classes
from tabloom.sources.shared import TEXT_CODEC, brief_shuffles, discard, materialize

WORDS = 4
ENTRIES = 64
SIMILARITY = 0.8
BLOCK_TEXTS = 2048
#: Words are counted in so many bags; texts whose counts differ too much can't be similar.
BAGS = 256
SEED = 11

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sketcher:
    """Order MinHash sketches of texts, computed over the bytes of the whole text at once."""

    def __init__(self, entries: int, words: int):
        draws = np.random.default_rng(SEED).integers(0, 1 << 63, (2, entries), dtype=np.uint64)
        self.xor, self.odd, self.words = draws[0][:, None], (draws[1] * np.uint64(2) + np.uint64(1))[:, None], words
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            size = max(n, 2 * len(self.power))
            factor = np.full(size, _BASE, dtype=np.uint64)
            inverse = np.full(size, _INVERSE, dtype=np.uint64)
            factor[0] = inverse[0] = 1
            self.power, self.inverse = np.multiply.accumulate(factor), np.multiply.accumulate(inverse)

    def word_hashes(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        inside = np.concatenate([[False], ~_WHITE[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=sums[1:])
        return _mixed((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def labelled(self, hashes: np.ndarray) -> np.ndarray:
        """Hash of every k-mer together with the number of its earlier occurrences, in text order."""
        n, k = len(hashes), min(self.words, len(hashes))
        if not n:
            return hashes
        kmers = np.full(n - k + 1, k, dtype=np.uint64)
        for d in range(k):
            kmers = _mixed(kmers * np.uint64(_BASE) + hashes[d : n - k + 1 + d])
        order = np.argsort(kmers, kind="stable")
        ordered = kmers[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        if first.all():
            return _mixed(kmers)
        at = np.arange(len(kmers))
        seen = np.empty(len(kmers), dtype=np.uint64)
        seen[order] = at - np.maximum.accumulate(np.where(first, at, 0))
        return _mixed(kmers + seen * np.uint64(_INVERSE))

    def sketch(self, text: str) -> tuple[list[int], int, bytes]:
        """The sketch, the number of words, and how many words fall into each bag."""
        hashes = self.word_hashes(text)
        labels = self.labelled(hashes)
        if not len(labels):
            return [], 0, bytes(2 * BAGS)
        bags = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % BAGS, minlength=BAGS)
        bags = np.minimum(bags, 65535).astype(np.uint16).tobytes()
        ranks = (labels[None, :] ^ self.xor) * self.odd
        ranks ^= ranks >> np.uint64(32)
        entry = np.arange(len(ranks))
        first = ranks.argmin(axis=1)
        second = first
        if len(labels) > 1:
            ranks[entry, first] = np.iinfo(np.uint64).max
            second = ranks.argmin(axis=1)
        early, late = labels[np.minimum(first, second)], labels[np.maximum(first, second)]
        keys = _mixed(_mixed(early * np.uint64(_BASE) + late) + entry.astype(np.uint64))
        return keys.view(np.int64).tolist(), len(hashes), bags


def word_ids(text: str, known: dict[bytes, int]) -> np.ndarray:
    words = text.encode().split()
    return np.fromiter((known.setdefault(word, len(known)) for word in words), dtype=np.int64, count=len(words))


def allowed(length: int, similarity: float) -> int:
    """Greatest distance of texts whose longer one has ``length`` words."""
    return int(length * (1 - similarity) + 1e-9)


def occurrences(items: np.ndarray, base: int) -> np.ndarray:
    """A number for every item (all below ``base``) together with its earlier occurrences in the array."""
    order = np.argsort(items, kind="stable")
    ordered, at = items[order], np.arange(len(items))
    fresh = np.ones(len(items), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    seen = np.empty(len(items), dtype=np.int64)
    seen[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return items + seen * base


def word_pairs(words: np.ndarray, base: int) -> np.ndarray:
    """A number below base * base for every two neighbouring words."""
    return words[:-1] * base + words[1:]


# What texts within ``limit`` edits have in common at least, counted with repeats: an edit changes one word
# and two neighbouring pairs at most.
def least_words(length, limit):
    return length - limit


def least_pairs(length, limit):
    return length - 1 - 2 * limit


def similar(a: np.ndarray, b: np.ndarray, similarity: float, base: int) -> bool:
    """Whether two texts of word numbers below ``base`` are similar enough; most others end at the counts."""
    longer = max(len(a), len(b))
    limit = allowed(longer, similarity)
    if abs(len(a) - len(b)) > limit:
        return False
    common = lambda x, y, top: len(np.intersect1d(occurrences(x, top), occurrences(y, top), assume_unique=True))
    return (
        common(a, b, base) >= least_words(longer, limit)
        and common(word_pairs(a, base), word_pairs(b, base), base * base) >= least_pairs(longer, limit)
        and distance_within(a, b, limit) is not None
    )


def digest(text: str) -> Column:
    """16 bytes that stand for the text."""
    return F.substring(F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)), 1, 16)


def sketches(df: DataFrame, key: str, text: str, entries: int, words: int) -> DataFrame:
    """(key, digest, sketch, size, bags) of every row, ``size`` being the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(entries, words)
        for batch in batches:
            found = [sketcher.sketch(body) for body in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("digest"),
                    pa.array([sketch for sketch, _, _ in found], pa.list_(pa.int64())),
                    pa.array([size for _, size, _ in found], pa.int64()),
                    pa.array([bags for _, _, bags in found], pa.binary()),
                ],
                ["key", "digest", "sketch", "size", "bags"],
            )

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), digest(text).alias("digest"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, digest binary, sketch array<long>, size long, bags binary")


def _bags(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint16).reshape(-1, BAGS).astype(np.int32)


def verify(pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of ``pairs`` (a, b, and text, size and bags of both) that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # An edit changes the counts of two bags by one at most.
            one, two = (_bags(batch.column(c).to_pylist()) for c in ("bags_a", "bags_b"))
            apart = np.abs(one - two).sum(axis=1)
            longer = np.maximum(*(batch.column(c).to_numpy() for c in ("size_a", "size_b")))
            near = apart <= 2 * (longer * (1 - similarity) + 1e-9).astype(int)
            keep = np.zeros(batch.num_rows, dtype=bool)
            texts = [batch.column(c) for c in ("text_a", "text_b")]
            for at in np.flatnonzero(near).tolist():
                known: dict[bytes, int] = {}
                a, b = (word_ids(column[at].as_py(), known) for column in texts)
                keep[at] = similar(a, b, similarity, max(len(known), 1))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a long, b long")


class Common:
    """Counts the items that each text of a block has in common with every other, by inverted lists."""

    def __init__(self, items: list[np.ndarray]):
        self.n = len(items)
        owner = np.repeat(np.arange(self.n), [len(x) for x in items])
        _, number, times = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
        several = times[number] > 1
        number, owner = number[several], owner[several]
        order = np.argsort(number, kind="stable")
        self.texts_of = owner[order]
        self.starts = np.searchsorted(number[order], np.arange(len(times) + 1))
        self.items_of = np.split(number, np.searchsorted(owner, np.arange(1, self.n)))

    def with_text(self, i: int) -> np.ndarray:
        numbers = self.items_of[i]
        starts, sizes = self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers]
        ends = np.cumsum(sizes)
        if not len(ends):
            return np.zeros(self.n, dtype=np.int64)
        places = np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)
        return np.bincount(self.texts_of[places], minlength=self.n)


class Block:
    """The texts of an entry and length, or of two of their blocks, in the order of their nodes."""

    def __init__(self, rows: pa.RecordBatch):
        self.entry, self.crossing = rows.column("entry")[0].as_py(), rows.column("first")[0] != rows.column("second")[0]
        self.nodes, self.lengths, self.block, self.label = (
            rows.column(c).to_numpy() for c in ("node", "size", "block", "class")
        )
        self.visitor = rows.column("visitor").to_numpy(zero_copy_only=False)
        self.rows = rows

    def candidates(self, similarity: float) -> list[tuple[int, np.ndarray]]:
        """What lengths, classes and counts of words in bags allow, without a look at the texts."""
        n, found, own = len(self.nodes), [], {}
        bags = _bags(self.rows.column("bags").to_pylist())

        def entries(i: int) -> set[int]:
            if i not in own:
                own[i] = set(self.rows.column("entries")[i].as_py())
            return own[i]

        for i in range(n - 1):
            limit = (np.maximum(self.lengths[i + 1 :], self.lengths[i]) * (1 - similarity) + 1e-9).astype(np.int64)
            ok = (self.label[i + 1 :] != self.label[i]) & (np.abs(self.lengths[i + 1 :] - self.lengths[i]) <= limit)
            ok &= ~(self.visitor[i + 1 :] & self.visitor[i])
            if self.crossing:
                ok &= self.block[i + 1 :] != self.block[i]
            rest = np.flatnonzero(ok)
            if len(rest):
                # An edit changes the counts of two bags by one at most.
                apart = np.abs(bags[i + 1 + rest] - bags[i]).sum(axis=1)
                rest = i + 1 + rest[apart <= 2 * limit[rest]]
                # A pair is compared in the first entry that both have.
                rest = rest[[min(entries(i) & entries(j)) == self.entry for j in rest.tolist()]] if len(rest) else rest
                if len(rest):
                    found.append((i, rest))
        return found

    def edges(self, similarity: float) -> list[tuple[int, int]]:
        """Links that join classes."""
        left = self.candidates(similarity)
        if not left:
            return []
        used = sorted({i for i, _ in left}.union(*(rest.tolist() for _, rest in left)))
        place = {i: at for at, i in enumerate(used)}
        known: dict[bytes, int] = {}
        texts = [word_ids(self.rows.column("text")[i].as_py(), known) for i in used]
        base = max(len(known), 1)
        words = Common([occurrences(text, base) for text in texts])
        pairs = Common([occurrences(word_pairs(text, base), base * base) for text in texts])
        label, edges = self.label.copy(), []
        for i, rest in left:
            others = rest[label[rest] != label[i]]
            if not len(others):
                continue
            at = np.asarray([place[j] for j in others.tolist()])
            longer = np.maximum(self.lengths[others], self.lengths[i])
            limit = (longer * (1 - similarity) + 1e-9).astype(np.int64)
            ok = pairs.with_text(place[i])[at] >= least_pairs(longer, limit)
            if ok.any():
                ok &= words.with_text(place[i])[at] >= least_words(longer, limit)
            for j, most in zip(others[ok].tolist(), limit[ok].tolist()):
                if label[i] != label[j] and distance_within(texts[place[i]], texts[place[j]], most) is not None:
                    edges.append((int(self.nodes[i]), int(self.nodes[j])))
                    label[label == label[j]] = label[i]
        return edges


BLOCK_KEY = ["entry", "g", "first", "second"]


def block_links(rows: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) of all blocks. Blocks come one after the other, most of them with a few texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []  # rows of a block that may go on in the next batch

        def linked(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            found = Block(pa.concat_batches(parts)).edges(similarity) if sum(p.num_rows for p in parts) > 1 else []
            return pa.RecordBatch.from_pydict(
                {"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())}
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in BLOCK_KEY], axis=1)
            if waiting and [waiting[0].column(c)[0].as_py() for c in BLOCK_KEY] != keys[0].tolist():
                yield linked(waiting)
                waiting = []
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                if start:
                    yield linked(waiting)
                    waiting = []
                waiting.append(batch.slice(start, end - start))
        if waiting:
            yield linked(waiting)

    dealt = rows.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY, "node")
    return dealt.mapInArrow(run, "a long, b long")


def _open_blocks(grouped: DataFrame, classes: DataFrame, similarity: float, block_texts: int) -> DataFrame:
    """Stored rows (entry, g, first, second, block, visitor, node, size, class): what is to be compared with what.

    An entry of more than a block has a group ``g`` for each range of lengths, with the texts of the next longer one
    as visitors; lengths that allow a link are in the same range or in neighbouring ones. Others are one group.
    """
    labelled = materialize(
        grouped.join(classes.withColumnRenamed("vertex", "node"), "node", "left")
        .select("entry", "node", "size", F.coalesce("component", "node").alias("class"))
    )
    opened = (
        labelled.groupBy("entry")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("class").alias("low"), F.max("class").alias("high"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("one"), F.bit_xor(F.xxhash64("node", F.lit(2))).alias("two"),
        )
        .where("low <> high")
    )
    # Entries with the same texts have the same pairs, which are compared in the first of them.
    opened = opened.groupBy("n", "low", "high", "one", "two").agg(F.min("entry").alias("entry")).select("entry", "n")
    step = -math.log(similarity) * 1.0001
    several = F.col("n") > block_texts
    roles = F.when(several, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    range_of = F.when(several, F.floor(F.log("size") / step)).otherwise(F.lit(0).cast("long"))
    placed = (
        labelled.join(materialize(opened), "entry")
        .withColumn("visitor", F.explode(roles))
        .withColumn("g", range_of - F.col("visitor").cast("long"))
        .drop("n")
    )
    placed = materialize(placed)
    discard(labelled)
    counts = placed.groupBy("entry", "g", "class").agg(
        F.count(F.lit(1)).alias("n"), F.sum((~F.col("visitor")).cast("long")).alias("home"),
        F.min("size").alias("least"), F.max("size").alias("most"),
    )
    counts = materialize(counts)
    groups = (
        counts.groupBy("entry", "g")
        .agg(
            F.max(F.struct("n", "class")).alias("major"), F.sum("n").alias("n"), F.sum("home").alias("home"),
            F.count(F.lit(1)).alias("classes"),
        )
        .where("home > 0 AND classes > 1")
    )
    groups = groups.select(
        "entry", "g", F.col("major.class").alias("major"),
        F.ceil(F.col("major.n") / block_texts).alias("majors"),
        F.ceil((F.col("n") - F.col("major.n")) / block_texts).alias("others"), (F.col("n") <= block_texts).alias("single"),
    )
    # A text of the largest class is needed only where the lengths of the others allow a link.
    lengths = counts.join(groups, ["entry", "g"]).where("class <> major").groupBy("entry", "g")
    groups = groups.join(lengths.agg(F.min("least").alias("least"), F.max("most").alias("most")), ["entry", "g"])
    # A group that fits into one block is one. Else the largest class has the first blocks and is compared with the
    # others only.
    blocks = F.col("majors") + F.col("others")
    spread = F.xxhash64("node", F.lit(SEED))
    major = F.col("class") == F.col("major")
    zero = F.lit(0).cast("long")
    apart = F.when(major, F.pmod(spread, "majors")).otherwise(F.col("majors") + F.pmod(spread, "others"))
    block = F.when(F.col("single"), zero).otherwise(apart)
    against = F.sequence(F.when(major, F.col("majors")).otherwise(zero), blocks - 1)
    other = F.when(F.col("single"), F.array(zero)).otherwise(against)
    near = (F.col("size") >= similarity * F.col("least") - 1e-6) & (similarity * F.col("size") <= F.col("most") + 1e-6)
    groups = materialize(groups)
    compared = materialize(
        placed.join(groups, ["entry", "g"])
        .where(~major | near)
        .withColumn("block", block)
        .withColumn("other", F.explode(other))
        .withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
        .select("entry", "g", "first", "second", "block", "visitor", "node", "size", "class")
    )
    discard(placed, counts, groups)
    return compared


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    entries: int = ENTRIES,
    words: int = WORDS,
    block_texts: int = BLOCK_TEXTS,
) -> DataFrame:
    """One row per row of ``df``: key, ``component_id`` (smallest key of its class), ``kept``.

    The disk holds what is still read, not all that was stored on the way.
    """
    with brief_shuffles(df.sparkSession):
        return _classified(df, key, text, similarity, entries, words, block_texts)


def _classified(
    df: DataFrame, key: str, text: str, similarity: float, entries: int, words: int, block_texts: int
) -> DataFrame:
    sketched = materialize(sketches(df, key, text, entries, words).withColumn("row", F.monotonically_increasing_id()))
    order = F.struct(F.col("key").isNull().alias("last"), F.col("key").alias("key"), F.col("row").alias("row"))
    distinct = sketched.groupBy("digest").agg(
        F.min("row").alias("node"), F.min(order).alias("least"), F.first("size").alias("size"), F.first("sketch").alias("sketch"),
        F.first("bags").alias("bags"),
    )
    distinct = materialize(distinct)
    members = materialize(sketched.select("key", "digest", "row"))
    discard(sketched)
    entry = distinct.select("node", "size", F.explode(F.array_distinct("sketch")).alias("entry"))
    # Few of the entries have a partner; the other rows are read no more. One shuffle brings an entry's texts together.
    of_entry = Window.partitionBy("entry")
    shared = entry.withColumns(
        {"n": F.count(F.lit(1)).over(of_entry), "leader": F.min(F.struct("node", "size")).over(of_entry)}
    )
    grouped = materialize(shared.where("n > 1").drop("n"))

    # Every text against the smallest of its entries.
    longer, shorter = F.greatest("size", "leader.size"), F.least("size", "leader.size")
    may = longer - shorter <= F.floor(longer * (1 - similarity) + 1e-9)
    pairs = grouped.where((F.col("node") != F.col("leader.node")) & may)
    stars = materialize(pairs.select(F.col("node").alias("a"), F.col("leader.node").alias("b")).distinct())
    # A text is fetched from one row, that with the least key, so copies stay where they are.
    wanted = distinct.join(grouped.select("node").distinct(), "node", "left_semi").select(
        F.col("digest").alias("d"), F.col("least.key").alias("k"), "node", F.col("size").alias("s"), F.col("bags").alias("b")
    )
    wanted = materialize(wanted)
    numbered = materialize(distinct.select("digest", "node"))
    discard(distinct)
    bodies = df.select(F.col(key).alias("key"), digest(text).alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d"))
    found = bodies.join(wanted.hint("merge"), same).groupBy("node").agg(
        F.first("text").alias("text"), F.first("s").alias("size"), F.first("b").alias("bags")
    )
    texts = materialize(found, codec=TEXT_CODEC)
    discard(wanted)
    side = lambda c: texts.select(*[F.col(n).alias(c if n == "node" else f"{n}_{c}") for n in texts.columns])
    star_edges = materialize(verify(stars.join(side("a"), "a").join(side("b"), "b"), similarity))
    classes = components(star_edges)
    discard(stars, star_edges)

    # Entries whose texts are still in several classes.
    blocked = _open_blocks(grouped, classes, similarity, block_texts)
    discard(grouped)
    own = blocked.groupBy("node").agg(F.collect_set("entry").alias("entries"))  # as many as a sketch has at most
    block_edges = block_links(blocked.join(texts.drop("size").join(own, "node"), "node"), similarity)
    linked = joined_classes(classes, block_edges)
    discard(blocked, texts)

    nodes = numbered.join(linked.withColumnRenamed("vertex", "node"), "node", "left")
    named = materialize(nodes.select("digest", F.coalesce("component", "node").alias("class")))
    discard(numbered)
    found = materialize(members.join(named, "digest").select("key", "row", "class"))
    discard(members, named)
    keepers = materialize(found.groupBy("class").agg(F.min(order).alias("keeper")))
    return found.join(keepers, "class").select(
        F.col("key").alias(key),
        F.col("keeper.key").alias("component_id"),
        (F.col("row") == F.col("keeper.row")).alias("kept"),
    )
