"""Groups of near-duplicate documents by BagMinHash banding and exact verification.

1. Equal texts are one node, named by its smallest id; signatures are computed per row in Arrow batches.
2. Nodes that agree in a whole band share a bucket. In a first round every member is paired with
   the bucket's head, so a bucket of n near copies costs n pairs and not n squared. Head is the member
   that shares buckets with most others: the text that a group of edited copies has in its middle, if
   it is there, heads all their buckets.
3. Pairs are verified on the texts: weighted Jaccard similarity of the five-word shingle multisets of
   `SIMILARITY` or more makes a link, and links make classes (connected components).
4. A link between members that are not both linked to the head may still be missing. In further
   rounds members outside the head's class are paired with all members of other classes, a
   bounded number of them per bucket and round, until none is left. The classes are those that all
   pairs of all buckets would give.

Pairs are only verified if their signatures agree in `AGREE` of 125 components or more; a pair of
similarity 0.8 fails that with probability 6e-6, and shares no bucket with probability 5e-5. In the
further rounds a node's shingles that no other node of those rounds has are counted first: what is
left bounds the overlap with any of them, and pairs whose bound is below the threshold are skipped.
In a large group of copies with edits of their own these are nearly all the pairs without a link.

Documents without words (null, empty or blank text) are classes of their own. Texts of one to four
words are one shingle. Rows with the same id are one document. Rows without id have the class of
equal texts that have ids, or else a null class. Long texts are compared whole. An empty table gives
an empty result; only the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm import bagminhash, sieve
from cargolens.llm.common import free_name, stored_in_buckets
from cargolens.operators.joins import lookup_join
from cargolens.sources.workspace import stored

SIMILARITY = 0.8
SERVED = 256  # members of a bucket that are paired with all others per round
REMEMBERED = 1000  # texts whose shingles are remembered while pairs are compared
TOGETHER = 100  # texts whose signatures are computed at once
AGREE = 81  # components in which the signatures of a pair must agree, of 125
BANDS = [f"b{k}" for k in range(bagminhash.BANDS)]
SKETCH = [f"s{k}" for k in range(bagminhash.SKETCH)]


def banded(text: Column) -> Column:
    """Band hashes of a text column; null for texts without words."""
    fields = ",".join(f"{c}:bigint" for c in BANDS + SKETCH)

    @F.arrow_udf(f"struct<{fields}>")
    def hashed(batch: pa.Array) -> pa.Array:
        known = np.zeros(len(batch), bool)
        table = np.zeros((len(batch), len(BANDS) + len(SKETCH)), np.uint64)
        for at in range(0, len(batch), TOGETHER):
            # Of a batch only so many texts are Python strings at a time.
            words = [bagminhash.word_hashes(t) for t in batch.slice(at, TOGETHER).to_pylist()]
            own = [k for k, w in enumerate(words) if len(w)]
            if own:
                found = bagminhash.signatures([bagminhash.shingle_hashes(words[k]) for k in own])
                rows = [at + k for k in own]
                known[rows] = True
                table[rows] = np.hstack([bagminhash.bands(found), bagminhash.sketches(found)])
        return pa.StructArray.from_arrays(
            [pa.array(column, mask=~known) for column in table.view(np.int64).T], BANDS + SKETCH)

    return hashed(text)


def agreement(mine: str, theirs: str) -> Column:
    """Number of equal components of two sketches whose columns have these prefixes."""
    differ = F.lit(0)
    for c in SKETCH:
        bits = F.col(mine + c).bitwiseXOR(F.col(theirs + c))
        seven = F.lit(0x7F7F7F7F7F7F7F)
        # In each byte the high bit of (low bits + 127) or of the byte itself tells that it is not 0.
        marks = (bits.bitwiseAND(seven) + seven).bitwiseOR(bits).bitwiseAND(F.lit(0x80808080808080))
        differ = differ + F.bit_count(marks)
    return F.lit(bagminhash.COMPONENTS) - differ


def similarity(left: Column, right: Column) -> Column:
    """Weighted Jaccard similarity of the shingles of two texts; texts of a group often repeat."""

    @F.arrow_udf("double")
    def compared(lefts: pa.Array, rights: pa.Array) -> pa.Array:
        shingles = lru_cache(REMEMBERED)(
            lambda text: bagminhash.shingle_hashes(bagminhash.word_hashes(text)))
        return pa.array([bagminhash.similarity(shingles(a.as_py()), shingles(b.as_py()))
                         for a, b in zip(lefts, rights, strict=True)], pa.float64())

    return compared(left, right)


def shareable(texts: DataFrame) -> DataFrame:
    """(node, size, common): a text's shingles, and how many of them some other text has too."""

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch[0], batch[1], strict=True):
                shingles = np.sort(bagminhash.shingle_hashes(bagminhash.word_hashes(text.as_py())))
                first = np.searchsorted(shingles, shingles)  # the n-th equal one is another element
                numbered = bagminhash.mixed(shingles + np.arange(len(shingles)).astype(np.uint64)
                                            - first.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(node, len(numbered)), pa.array(numbered.view(np.int64))],
                    ["node", "element"])

    kind = texts.schema["node"].dataType.simpleString()
    found = texts.select("node", "text").mapInArrow(elements, f"node {kind}, element bigint")
    alone = (found.groupBy("element").agg(F.count("*").alias("n"), F.min("node").alias("node"))
             .where("n = 1").groupBy("node").agg(F.count("*").alias("alone")))
    words = F.size(F.split(F.trim(F.regexp_replace("text", r"[\x09-\x0D\x20]+", " ")), " "))
    size = F.greatest(words - (bagminhash.SHINGLE - 1), F.lit(1))
    sizes = texts.select("node", size.alias("size")).join(alone, "node", "left")
    return sizes.select("node", "size", (F.col("size") - F.coalesce("alone", F.lit(0)))
                        .alias("common"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, d): the distance of each pair of nodes."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b")
    return stored(both.select("a", "b", (1 - similarity(F.col("text_a"), F.col("text_b"))).alias("d")), "pairs")


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Classes of nodes after adding links (a, b) to the classes in `labels` (node, cls).

    Every class takes the smallest name it is linked to, that name's new name is looked up at once, and
    this repeats with the links that still join different classes until there are none. Ends of equal
    class stay equal, so a dropped link is not needed again; the smallest node of a component never
    changes its name, so in the end all have that name.
    """
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if labels is None:
        labels = nodes.select("node", F.col("node").alias("cls"))
    else:
        labels = nodes.join(labels, "node", "full").select("node", F.coalesce("cls", "node").alias("cls"))
    labels = stored(labels, "labels")
    while True:
        one = labels.select(F.col("node").alias("a"), F.col("cls").alias("ca"))
        two = labels.select(F.col("node").alias("b"), F.col("cls").alias("cb"))
        links = stored(links.join(one, "a").join(two, "b").where("ca <> cb")
                       .select("a", "b", "ca", "cb"), "links")
        if links.isEmpty():
            return labels
        ends = links.select("ca", "cb").union(links.select("cb", "ca"))
        hooked = (ends.groupBy(F.col("ca").alias("cls")).agg(F.min("cb").alias("to"))
                  .select("cls", F.least("cls", "to").alias("to")))
        hooked = stored(hooked, "hooked")
        again = hooked.select(F.col("cls").alias("to"), F.col("to").alias("further"))
        hooked = hooked.join(again, "to", "left").select(
            "cls", F.coalesce("further", "to").alias("to"))
        labels = stored(labels.join(hooked, "cls", "left").select(
            "node", F.coalesce("to", "cls").alias("cls")), "labels")
        links = links.select("a", "b")


def nodes_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One stored row per document row: id, digest of the text and hashes; null without words."""
    rows = docs.select(F.col(key).alias("id"), F.md5(F.col(text).cast("binary")).alias("digest"),
                       banded(F.col(text)).alias("bands"))
    rows = rows.select("id", F.when(F.col("bands.b0").isNotNull(), F.col("digest"))
                       .alias("digest"), "bands.*")
    return stored(rows, "signatures")


def candidates(docs: DataFrame, key: str, text: str, nodes: DataFrame) -> DataFrame:
    """(node, text) of the given nodes, in buckets by node, so that later joins move the pairs and not the texts."""
    rows = docs.select(F.col(key).alias("node"), F.col(text).alias("text"))
    found = sieve.semi_join(rows, "node", nodes, "node")
    return stored_in_buckets(found.groupBy("node").agg(F.min("text").alias("text")), "node", "candidates")


def link_classes(docs: DataFrame, key: str, text: str, reps: DataFrame,
                 least: float = SIMILARITY) -> DataFrame:
    """(node, cls) of all nodes that are linked to another one."""
    far = 1 - least + 1e-9
    members = reps.select("node", F.explode(F.array(*BANDS)).alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    # Buckets of one member are most of all; they end here, before the sketches come in.
    members = stored(members.join(sizes.where("n > 1"), "bucket"), "members")
    company = members.groupBy("node").agg(F.sum("n").alias("company"))
    most = (members.join(company, "node").groupBy("bucket")
            .agg(F.max(F.struct("company", (-F.col("node")).alias("minus"))).alias("most")))
    heads = most.select("bucket", (-F.col("most.minus")).alias("head"))
    members = stored(members.join(heads, "bucket"), "headed")
    sketched = reps.select("node", *SKETCH).join(members.select("node").distinct(), "node",
                                                 "left_semi").dropDuplicates(["node"])
    members = stored(members.join(sketched, "node"), "sketched")
    texts = candidates(docs, key, text, members.select("node").distinct())

    def pairs_of(near: DataFrame) -> DataFrame:
        """Pairs of a leader and a node that agree enough, each once, the smaller one first."""
        return near.select(F.least("node", "leader").alias("a"),
                           F.greatest("node", "leader").alias("b")).distinct()

    heads = members.where("node = head").select(
        "bucket", F.col("node").alias("leader"), *(F.col(c).alias(f"l{c}") for c in SKETCH))
    near = members.join(heads, (members["bucket"] == heads["bucket"])
                        & (F.col("node") != F.col("leader")) & (agreement("", "l") >= AGREE))
    done = verified(pairs_of(near), texts)
    labels = merged(None, done.where(F.col("d") <= far).select("a", "b"))

    # Buckets of two are settled, and those without members outside the head's class.
    members = members.where("n > 2").withColumn("served", F.col("node") == F.col("head"))

    def with_classes(members: DataFrame) -> DataFrame:
        of_head = labels.select(F.col("node").alias("head"), F.col("cls").alias("head_cls"))
        classed = (members.join(labels, "node", "left").join(of_head, "head", "left")
                   .withColumn("cls", F.coalesce("cls", "node"))
                   .withColumn("waits", ~F.col("served")
                               & (F.col("cls") != F.coalesce("head_cls", "head")))
                   .drop("head_cls"))
        mixed = classed.groupBy("bucket").agg(F.max("waits").alias("open")).where("open")
        return stored(classed.join(mixed.select("bucket"), "bucket", "left_semi"), "classed")

    classed = with_classes(members)
    if classed.isEmpty():
        return labels
    waiting = stored(classed.select("node").distinct(), "open_nodes")
    open_texts = texts.join(waiting, "node", "left_semi")
    own = (members.join(waiting, "node", "left_semi").groupBy("node")
           .agg(F.collect_set("bucket").alias("own")))  # 25 for each text of the node
    classed = stored(classed.join(shareable(open_texts), "node").join(own, "node"), "classed")
    overlap = F.least("common", "leader_common")
    enough = overlap >= least * (F.col("size") + F.col("leader_size") - overlap) - 1e-6
    carried = ["size", "common", "own", *SKETCH]
    while True:
        turn = classed.where("waits").selectExpr(
            "bucket", "node", "row_number() over (partition by bucket order by node) as turn")
        leaders = stored(turn.where(F.col("turn") <= SERVED).drop("turn"), "leaders")
        if leaders.isEmpty():
            return labels
        leading = classed.join(leaders, ["bucket", "node"]).select(
            F.col("bucket").alias("place"), F.col("node").alias("leader"), F.col("cls").alias("leader_cls"),
            F.col("size").alias("leader_size"), F.col("common").alias("leader_common"),
            F.col("own").alias("leader_own"),
            *(F.col(c).alias(f"l{c}") for c in SKETCH))
        # A pair that shares several buckets is looked at in one of them. Any would do: each either has both
        # in its head's class, or one of the two is paired there with all that are in other classes.
        near = classed.join(leading, (F.col("bucket") == F.col("place"))
                            & (F.col("cls") != F.col("leader_cls")) & enough
                            & (agreement("", "l") >= AGREE)
                            & (F.array_min(F.array_intersect("own", "leader_own")) == F.col("place")))
        pairs = stored(pairs_of(near).join(done, ["a", "b"], "left_anti"), "new_pairs")
        if not pairs.isEmpty():
            fresh = verified(pairs, texts)
            done = done.union(fresh)
            labels = merged(labels, fresh.where(F.col("d") <= far).select("a", "b"))
        members = (classed.join(leaders.withColumn("now", F.lit(True)), ["bucket", "node"], "left")
                   .select("bucket", "head", "node", *carried,
                           (F.col("served") | F.coalesce("now", F.lit(False))).alias("served")))
        classed = with_classes(members)


def classified(docs: DataFrame, key: str, text: str, least: float) -> DataFrame:
    """(id, digest, class_id) of every row of `docs`; the digest is null without words."""
    rows = nodes_of(docs, key, text)
    worded = rows.where(F.col("digest").isNotNull())
    reps = stored(worded.groupBy("digest").agg(F.min("id").alias("node"),
                                               *(F.min(c).alias(c) for c in BANDS + SKETCH)), "reps")
    labels = link_classes(docs, key, text, reps.where(F.col("node").isNotNull()), least)
    # A node may stand for several texts if they share an id; its classes are the same.
    named = reps.select("digest", "node").join(labels, "node", "left").select(
        "digest", F.coalesce("cls", "node").alias("class_id"))
    # Rows without words have no digest and so no partner.
    found = lookup_join(rows.select("id", "digest"), stored(named, "named"), "digest", "left",
                        spread=["id"])
    own = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("class_id"))
    return found.select("id", "digest", own.alias("class_id"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text",
            least: float = SIMILARITY) -> DataFrame:
    """One row per row of `docs`: its id and its class, named by the smallest id in it."""
    return classified(docs, key, text, least).select(F.col("id").alias(key), "class_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of the smallest id of every class, once, with its columns; rows without id stay.

    Of an id with several texts only those go that are in the class of a smaller id. Near copies are
    still looked for with one text per id, the smallest.
    """
    found = stored(classified(docs, key, text, SIMILARITY).where(F.col("id").isNotNull()), "classes")
    name = free_name(docs, "__key")
    copies = found.where(F.col("id") != F.col("class_id"))
    gone = copies.select(F.col("id").alias(name)).distinct()
    often = found.groupBy("id").count().where("count > 1").select(F.col("id").alias(name))
    if often.isEmpty():
        return sieve.anti_join(docs, key, gone, name)
    often = stored(often, "repeated")
    once = (docs.join(often, F.col(key) == F.col(name), "left_anti")
            .join(gone, F.col(key) == F.col(name), "left_anti"))
    digest = free_name(docs, "__digest")
    texts = copies.select(F.col("id").alias(name), F.col("digest").alias(digest)).distinct()
    again = (docs.join(often, F.col(key) == F.col(name), "left_semi")
             .join(texts, (F.col(key) == F.col(name))
                   & (F.md5(F.col(text).cast("binary")) == F.col(digest)), "left_anti")
             .dropDuplicates([key]))
    return once.union(again)
