"""Near-duplicate documents: bottom-k sketches, inverted lists, exact Jaccard, connected components.

1. A document's set holds the 63-bit hashes of its distinct word shingles; its sketch is the SKETCH
   smallest of them. Documents with equal sets form one class, and only classes go on.
2. Inverted lists. Two sets with a Jaccard similarity of at least t share at least s sketch values: for sets that fit
   in a sketch this follows from the sizes, for larger ones s is the largest number that they fall short of with a
   chance of CHANCE at most, by the tail of the binomial distribution. In one order of all values, rarest first, such sketches must then
   share a value among their first k - s + 1. Only those values are listed, and only where a second class has
   the value, so a passage that many documents share puts none of them on a list.
   The place of a value in that order also bounds what two sets of given sizes can share.
3. Candidates. Lists of up to SHORT classes give their pairs. Classes on longer lists are listed anew by
   their full sets, where the bounds on the places are exact. On a list that is still long, a hub is compared with
   the members outside its component, in rounds with more hubs each, until the list
   lies in one component or each member has been a hub. A group of thousands of near copies is
   thereby joined without all its pairs.
4. The k smallest values of the union of two sketches are a sample of the union of the sets: pairs whose share of common
   values there is too low (again with a chance of CHANCE at most for a similar pair) are dropped. The others are confirmed
   on the full sets.

The tables of sketches, lists and links are Parquet in the shared folder, and are removed after their last
reader; nothing but counts reaches the driver.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeromart.llm import words as W
from aeromart.llm.components import components
from aeromart.llm.staging import discard, staged
from aeromart.session import staging

SKETCH = 128
#: The chance with which a bound on sampled values may fail for a pair of similar sets.
CHANCE = 1e-9
#: Shares of foreign values are rounded up to multiples of 1 / STEPS.
STEPS = 64
SHORT = 40
GROWTH = 64


@lru_cache(maxsize=256)
def most(k: int, numerator: int, denominator: int) -> int:
    """The least number that a sample of k with the given share of foreign values exceeds with a chance of CHANCE at most."""
    share, tail = min(1.0, numerator / denominator), 0.0
    for n in range(k, 0, -1):
        tail += comb(k, n) * share**n * (1 - share) ** (k - n)
        if tail > CHANCE:
            return n
    return 0


@dataclass(frozen=True)
class Rule:
    """Words per shingle, least similarity in percent, size of a sketch."""

    shingle: int = 5
    percent: int = 80
    sketch: int = SKETCH

    @property
    def shared_of_full(self) -> int:
        """Least number of common values among the `sketch` smallest of a union of larger sets."""
        return max(1, self.sketch - most(self.sketch, 100 - self.percent, 100))

    def listed(self, n: Column) -> Column:
        """How many of a set's sketch values are listed."""
        t, k = self.percent, self.sketch
        whole = F.floor((t * n + 99) / 100) - F.greatest(F.floor(n * 100 / t) - k, F.lit(0))
        least = F.when(n <= k, F.greatest(whole, F.lit(1))).otherwise(self.shared_of_full)
        return (F.least(n, F.lit(k)) - least + 1).cast("int")

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= self.percent * F.greatest(a, b)

    def missing(self, n: Column, other: Column) -> Column:
        """How many sketch values of a set of n may be foreign to a similar set of size `other`.

        Of the larger set a share m = 1 - c / max(n, other) is foreign, c being the least number of common
        shingles. Sets that fit in a sketch have n - c foreign values at most. Of larger ones, a sketch of k
        has `most(k, m)`. If only one set fits, nothing is ruled out.
        """
        k = F.lit(self.sketch)
        common = (n + other) * self.percent / (100 + self.percent)
        m = F.greatest(1 - common / F.greatest(n, other), F.lit(0.0))
        limits = F.array(*[F.lit(most(self.sketch, i, STEPS)) for i in range(STEPS + 1)])
        sampled = F.get(limits, F.least(F.ceil(m * STEPS), F.lit(STEPS)).cast("int"))
        return F.when((n <= k) & (other <= k), n - common).when((n > k) & (other > k), sampled).otherwise(k)

    def may_meet(self, n_a: Column, at_a: Column, n_b: Column, at_b: Column, exact: bool) -> Column:
        """May two sets be similar whose rarest common value has the places at_a and at_b in their order? `exact` for full sets."""
        common = (n_a + n_b) * self.percent / (100 + self.percent)
        most_a, most_b = (n_a - common, n_b - common) if exact else (self.missing(n_a, n_b), self.missing(n_b, n_a))
        return self.sizes_fit(n_a, n_b) & (at_a <= most_a + 1e-6) & (at_b <= most_b + 1e-6)

    def similar(self, common: Column, union: Column) -> Column:
        return common * 100 >= union * self.percent


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Per text the sorted 63-bit hashes of its distinct shingles; a text of fewer words has one, of all its words."""
    texts = W.Texts(column)
    raw = W.LOWER[texts.raw]
    starts, ends, first = W.words(texts)
    hashes = W.span_hashes(raw, starts, ends)
    windows = W.window_hashes(hashes, size) >> np.uint64(1)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if high - low >= size:
            yield np.unique(windows[low : high - size + 1]).view(np.int64)
        elif high > low:
            yield (W.window_hashes(hashes[low:high], high - low) >> np.uint64(1)).view(np.int64)
        else:
            yield np.zeros(0, np.int64)


def sketches(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n (size of the set), high and low (a hash of the whole set), sketch (ascending)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            n, high, low, kept = [], [], [], []
            for own in shingle_sets(block["text"], rule.shingle):
                values = own.view(np.uint64)
                n.append(len(own))
                high.append(W.mixed(values).sum(dtype=np.uint64))
                low.append(W.mixed(values + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64))
                kept.append(own[: rule.sketch])
            offsets = np.cumsum([0, *map(len, kept)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(kept)))
            hashes = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (high, low)]
            yield pa.RecordBatch.from_arrays([block["doc_id"], pa.array(n, pa.int64()), *hashes, lists], names=["doc_id", "n", "high", "low", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, high long, low long, sketch array<long>")


def full_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """(class, set, all): the whole sets of the rows (class, text), and a hash of each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            own = list(shingle_sets(block["text"], rule.shingle))
            offsets = np.cumsum([0, *map(len, own)]).astype(np.int32)
            marks = pa.array(np.array([W.mixed(x.view(np.uint64)).sum(dtype=np.uint64) for x in own], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([block["class"], marks, pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(own)))], names=["class", "set", "all"])

    return docs.mapInArrow(run, "class long, set long, all array<long>")


class _Search:
    """Links between the classes of one document table."""

    def __init__(self, docs: DataFrame, rule: Rule):
        self.rule = rule
        own = staged(sketches(docs.where("doc_id IS NOT NULL"), rule), "sketches")
        self.documents = staged(own.drop("sketch"), "documents")
        filled = own.where("n > 0")
        #: One row per distinct set: its smallest id, its size and its sketch.
        self.classes = staged(filled.groupBy("high", "low", "n").agg(F.min("doc_id").alias("class"), F.min_by("sketch", "doc_id").alias("sketch")), "classes")
        discard(own)
        values = self.classes.select("class", "n", F.col("high").alias("set"), F.explode("sketch").alias("value"))
        kept = F.least(F.col("n"), F.lit(rule.sketch))
        self.lists = staged(self._listed(values, kept, rule.listed(F.col("n"))), "lists")
        counts = self.lists.groupBy("value").agg(F.count("*").alias("members")).where("members > 1")
        self.counts = staged(counts, "counts")
        needed = self.lists.join(self.counts, "value", "left_semi").select("class").distinct()
        texts = docs.select(F.col("doc_id").alias("class"), "text").join(needed, "class", "left_semi")
        self.sets = staged(full_sets(texts, rule), "sets")

    def _listed(self, values: DataFrame, kept: Column, budget: Column) -> DataFrame:
        """(value, class, n, place): the first `budget` of the `kept` values of each set, rarest first, without those that one set alone has."""
        common = values.groupBy("value").agg(F.count("*").alias("held")).where("held > 1")
        own = values.join(common, "value").groupBy("class", "set", "n").agg(F.sort_array(F.collect_list(F.struct("held", "value"))).alias("own"))
        alone = kept - F.size("own")
        listed = own.select("class", "n", alone.cast("int").alias("alone"), (budget - alone).cast("int").alias("first"), "own").where("first > 0")
        listed = listed.select("class", "n", "alone", F.posexplode(F.slice("own", F.lit(1), F.col("first"))).alias("at", "v"))
        return listed.select("v.value", "class", "n", (F.col("alone") + F.col("at")).cast("int").alias("place"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links: estimated on the union of the sketches, then checked on the full sets."""
        k = self.rule.sketch
        sketch = self.classes.select("class", "sketch", "n")
        sides = pairs.join(sketch.toDF("a", "own_a", "n_a"), "a").join(sketch.toDF("b", "own_b", "n_b"), "b")
        union = F.slice(F.array_sort(F.array_union("own_a", "own_b")), 1, k)
        common = F.size(F.array_intersect(F.array_intersect("own_a", "own_b"), F.col("union")))
        both = F.size(F.array_intersect("own_a", "own_b"))
        near = (F.size("own_a") - both <= self.rule.missing(F.col("n_a"), F.col("n_b"))) & (F.size("own_b") - both <= self.rule.missing(F.col("n_b"), F.col("n_a")))
        likely = sides.where(near).withColumn("union", union)
        likely = likely.where((common >= self.rule.shared_of_full) | ((F.size("union") < k) & self.rule.similar(common, F.size("union"))))
        sets = self.sets.select("class", "all")
        whole = likely.select("a", "b").join(sets.toDF("a", "all_a"), "a").join(sets.toDF("b", "all_b"), "b")
        shared = F.size(F.array_intersect("all_a", "all_b"))
        return whole.where(self.rule.similar(shared, F.size("all_a") + F.size("all_b") - shared)).select("a", "b").distinct()

    def labelled(self, members: DataFrame, found: DataFrame | None) -> DataFrame:
        """members (value, class, n, place) with the component of each class so far."""
        members = members.select("value", "class", "n", "place")
        if found is None:
            return members.withColumn("component", F.col("class"))
        return members.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))

    def links(self) -> DataFrame:
        """Links that join the components of all similar pairs."""
        long = self.counts.where(F.col("members") > SHORT).select("value")
        short = self.lists.join(long, "value", "left_anti")
        found = known = None
        if not long.isEmpty():
            inside = self.lists.join(long, "value", "left_semi").select("class").distinct()
            found = self._of_full_sets(inside)
            known = components(found).toDF("class", "component")
        last = self._all_pairs(short, known, exact=False)
        discard(self.lists, self.counts, self.sets)
        return last if found is None else found.unionByName(last)

    def _of_full_sets(self, classes: DataFrame) -> DataFrame:
        """Links between classes of long lists, from lists of their full sets, whose bounds on the places are exact."""
        sets = self.sets.join(classes, "class", "left_semi")
        n = F.size("all").cast("long").alias("n")
        values = sets.select("class", "set", n, F.explode("all").alias("value"))
        budget = F.col("n") - F.floor((F.col("n") * self.rule.percent + 99) / 100) + 1
        lists = staged(self._listed(values, F.col("n"), budget), "full-lists")
        long = staged(lists.groupBy("value").count().where(F.col("count") > SHORT).select("value"), "full-long")
        links, known = self._by_hubs(lists.join(long, "value", "left_semi"))
        rest = self._all_pairs(lists.join(long, "value", "left_anti"), known, exact=True)
        discard(lists)
        return rest if links is None else links.unionByName(rest)

    def _all_pairs(self, members: DataFrame, known: DataFrame | None, exact: bool) -> DataFrame:
        """Links among the members of short lists that are not yet in one component."""
        members = self.labelled(members, known)
        a, b = (members.select("value", *(F.col(c).alias(f"{c}_{side}") for c in ("class", "n", "place", "component"))) for side in "ab")
        apart = (F.col("class_a") < F.col("class_b")) & (F.col("component_a") != F.col("component_b"))
        apart &= self.rule.may_meet(F.col("n_a"), F.col("place_a"), F.col("n_b"), F.col("place_b"), exact)
        pairs = a.join(b, (a["value"] == b["value"]) & apart).select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()
        return staged(self.confirmed(pairs), "links")

    def _by_hubs(self, members: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
        """Links found on long lists of full sets, and (class, component) of the classes that they join.

        The first hub of a list is the member with the fewest rarer values, which is the likeliest to be near all others.
        """
        links = known = used = None
        salts = 1
        state = staged(self.labelled(members, None), "state")
        while True:
            open_lists = state.groupBy("value").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("value")
            free = state.join(open_lists, "value", "left_semi")
            if used is not None:
                free = free.join(used, ["value", "class"], "left_anti")
            salt = F.pmod(F.xxhash64("class"), F.lit(salts))
            hubs = staged(free.groupBy("value", salt.alias("salt")).agg(F.min(F.struct("place", "class", "n", "component")).alias("hub")), "hubs")
            if hubs.isEmpty():
                discard(state)
                return links, known
            apart = (state["class"] != F.col("hub.class")) & (state["component"] != F.col("hub.component"))
            apart &= self.rule.may_meet(state["n"], state["place"], F.col("hub.n"), F.col("hub.place"), exact=True)
            pairs = state.join(hubs.withColumnRenamed("value", "at"), (F.col("value") == F.col("at")) & apart)
            pairs = pairs.select(F.least("class", "hub.class").alias("a"), F.greatest("class", "hub.class").alias("b")).distinct()
            found = staged(self.confirmed(pairs), "links")
            now = hubs.select("value", "hub.class")
            used = now if used is None else used.unionByName(now)
            salts *= GROWTH
            if not found.isEmpty():
                links = found if links is None else links.unionByName(found)
                known = components(links).toDF("class", "component")
                old, state = state, staged(self.labelled(state, known), "state")
                discard(old)


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles, component_id, kept of every row of `docs`.

    Texts are compared in lower-case ASCII letters. Documents with a null, empty or wordless text are
    linked with nothing and kept. Rows that share an id are one document: links of any of their texts
    count, and every row gets the same component. A row without an id has no component and is kept.
    Other columns are not read. The result is written to the shared folder, and all tables on the way to it are removed.
    """
    with staging(docs.sparkSession):
        search = _Search(docs, rule)
        found = components(search.links()).toDF("class", "component")
        sets = search.classes.select("high", "low", F.col("n").alias("size"), "class").join(found, "class", "left")
        sets = sets.select("high", "low", "size", F.coalesce("component", "class").alias("component"))
        own = search.documents
        same = (own["n"] == sets["size"]) & (own["high"] == sets["high"]) & (own["low"] == sets["low"])
        rows = own.join(sets, same, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
        lone = sketches(docs.where("doc_id IS NULL"), rule).select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
        found = rows.unionByName(lone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        return staged(found, "components", keep=True)


def keep_one(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """The rows of `docs` that are the first of their group, with all their columns.

    Of rows that share an id all stay or go together.
    """
    gone = near_duplicates(docs, rule).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(*(docs[f"`{c}`"] for c in docs.columns))
