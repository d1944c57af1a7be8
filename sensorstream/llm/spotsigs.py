"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

An anchor is one of a fixed list of very common words; its signature is the anchor with the next
`CHAIN` words that are no anchors. Boilerplate and lists have few anchors, so signatures come from
prose. A fingerprint is the set of a text's signatures as sorted 32-bit hashes, written in hex. Two
fingerprints are as alike as the Jaccard similarity of their sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstream.llm.common import hashed_words, mix, pieces, text_bytes

CHAIN = 2

# Common words of the languages in hand, the anchors.
ANCHORS = (
    "a an and are as at be by for from has have he her his in is it not of on or she that the their they this to was we were what which who will with you "
    "aber als am an auch auf aus bei das dem den der des die ein eine einen einer es für hat ich im in ist mit nach nicht noch nur oder sich sie sind so und von war wie zu zum zur "
    "à au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son sur un une vous y "
    "al como con cuando de del el ella en entre era es esta este ha la las le lo los me más mi muy no nos o para pero por porque que se ser si sin sobre su sus también un una y ya"
).split()

_WORD = np.ones(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False
_ANCHOR_HASHES = np.unique(hashed_words(*text_bytes(pa.array(ANCHORS)), _WORD)[0])


def signature_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each text its sorted distinct signatures (32 bits). Words are runs of letters, digits and other
    non-ASCII characters, lower-cased. A text without any chain has one signature for each
    of its words; without words, one of its characters; the empty text (and null) has none."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    data, at = text_bytes(pc.utf8_lower(texts))
    words, owner = hashed_words(data, at, _WORD)
    bounds = np.searchsorted(owner, np.arange(len(at)))
    anchor = np.isin(words, _ANCHOR_HASHES, kind="sort")
    content = np.flatnonzero(~anchor)
    heads = np.flatnonzero(anchor)
    first = np.searchsorted(content, heads)
    whole = first + CHAIN <= len(content)
    heads, first = heads[whole], first[whole]
    same = owner[content[first + CHAIN - 1]] == owner[heads] if len(heads) else np.zeros(0, bool)
    heads, first = heads[same], first[same]
    value = words[heads]
    for i in range(CHAIN):
        value = mix(value * np.uint64(0xD6E8FEB86659FD93) + words[content[first + i]])
    value = (value >> np.uint64(32)).astype(np.uint32)
    spans = np.searchsorted(owner[heads], np.arange(len(at)))
    out = []
    for i in range(len(at) - 1):
        a, b = spans[i], spans[i + 1]
        if b > a:
            out.append(np.unique(value[a:b]))
        elif bounds[i + 1] > bounds[i]:
            out.append(np.unique((mix(words[bounds[i] : bounds[i + 1]]) >> np.uint64(32)).astype(np.uint32)))
        elif at[i + 1] > at[i]:
            out.append(np.frombuffer(hashlib.sha256(data[at[i] : at[i + 1]].tobytes()).digest()[:4], np.uint32))
        else:
            out.append(np.zeros(0, np.uint32))
    return out


def to_text(signatures: np.ndarray) -> str:
    return signatures.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two signature sets; two empty sets are alike. With `least`, pairs whose lengths
    alone keep them below it are 0 without a comparison."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_signatures, fingerprint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = signature_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([len(s) for s in sets], pa.int32()), pa.array(list(map(to_text, sets)), pa.string())], names=["key", "n_signatures", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n_signatures int, fingerprint string")
    return found.withColumnRenamed("key", key)


def length_partition(n: F.Column, threshold: float) -> F.Column:
    """Partition of a set length: lengths of one partition are within the threshold's ratio, so sets that
    reach it are in the same or in neighbouring partitions."""
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / -np.log(threshold)).cast("int")


def similar_pairs(found: DataFrame, threshold: float = 0.8, key: str = "doc_id") -> DataFrame:
    """(a, b, similarity) for the different fingerprints in `fingerprints` whose similarity reaches `threshold`, a and b
    being the least keys with these fingerprints. Sets are dealt by length partition, their own and the next; of
    each, the rarest signatures that any partner must share are looked up; lengths prune before sets are
    compared. Equal fingerprints are one class before anything is paired. Empty fingerprints have no partner."""
    classes = found.where("n_signatures > 0").groupBy("fingerprint", "n_signatures").agg(F.min(key).alias("id"))
    split = F.transform(F.sequence(F.lit(1), F.col("n_signatures")), lambda i: F.substring(F.col("fingerprint"), i * 8 - 7, F.lit(8)))
    sets = classes.select("id", F.col("n_signatures").alias("n"), split.alias("sigs"))
    each = sets.select("id", "n", F.explode("sigs").alias("sig"))
    rarity = each.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = each.join(rarity, "sig").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("common"))
    missing = F.col("n") - F.size("common")
    prefix = F.greatest(F.col("n") - F.ceil(F.col("n") * threshold).cast("int") + 1 - missing, F.lit(0))
    probes = ranked.select("id", "n", F.explode(F.slice(F.col("common")["sig"], F.lit(1), prefix)).alias("sig"))
    own = length_partition(F.col("n"), threshold)
    index = probes.withColumn("part", F.explode(F.array(own, own + 1)))
    left, right = index.where(F.col("part") == own), index
    pairs = left.alias("x").join(right.alias("y"), ["part", "sig"]).where("x.id <> y.id and x.n >= y.n").where(F.col("y.n") >= F.col("x.n") * threshold)
    pairs = pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    full = pairs.join(sets.select(F.col("id").alias("a"), F.col("sigs").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("sigs").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return full.select("a", "b", (both / (F.size("sa") + F.size("sb") - both)).alias("similarity")).where(F.col("similarity") >= threshold)


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _ahead(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, ahead, key, text): rows dealt to ranges of the key, and to each range also the first row of
    the next one (of the first one after the last), marked `ahead`. Only range bounds pass the driver."""
    from pyspark.ml.feature import Bucketizer

    shares = [i / buckets for i in range(1, buckets)]
    bounds = sorted({float(x) for x in docs.agg(F.percentile_approx("key", shares, max(10_000, 20 * buckets))).first()[0] or []}) if shares else []
    placed = docs.withColumn("_at", F.coalesce(F.col("key").cast("double"), F.lit(float("-inf"))))
    if bounds:
        cutter = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="_at", outputCol="_bucket")
        placed = cutter.transform(placed)
    else:
        placed = placed.withColumn("_bucket", F.lit(0.0))
    placed = placed.select(F.col("_bucket").cast("int").alias("bucket"), "key", "text")
    firsts = sorted(placed.groupBy("bucket").agg(F.min(F.struct(F.col("key").isNotNull().alias("set"), "key"))["key"].alias("first")).collect())
    turned = [(firsts[i - 1]["bucket"], r["bucket"], r["first"]) for i, r in enumerate(firsts)]
    heads = docs.sparkSession.createDataFrame(turned, "into int, bucket int, first long")
    # Only rows that are somebody's first go into the join; the list is as long as there are ranges.
    known = [r["first"] for r in firsts if r["first"] is not None]
    likely = F.coalesce(F.col("key").isin(known), F.lit(len(known) < len(firsts))) if known else F.lit(True)
    placed_heads = placed.where(likely)
    again = placed_heads.join(heads, (placed_heads["bucket"] == heads["bucket"]) & placed_heads["key"].eqNullSafe(heads["first"])).select(F.col("into").alias("bucket"), F.lit(True).alias("ahead"), "key", "text")
    return placed.select("bucket", F.lit(False).alias("ahead"), "key", "text").unionByName(again)


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """Fingerprint every text and its edited text, whose last quarter (floor of n/4 code points) gives way to as many first
    code points of the next document's text in ascending key order; after the last comes the first.

    Texts travel once: each range of keys also gets the row that follows it, and is read in order. Null keys
    come first, null texts are empty, rows with equal keys follow each other by text; a lone row is its own
    successor. An empty table gives an empty table. Other columns are not read."""
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    dealt = _ahead(plain, buckets).repartition("bucket").sortWithinPartitions("bucket", "ahead", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = part.select(["bucket", "ahead", "key", "text"])
                if carry is not None:
                    rows = pa.Table.from_batches([carry, rows]).combine_chunks().to_batches()[0]
                carry = rows.slice(len(rows) - 1)
                keep = np.flatnonzero(~rows.column("ahead").to_numpy(zero_copy_only=False)[:-1])
                if not len(keep):
                    continue
                texts = rows.column("text").to_pylist()
                sets = signature_sets(rows.column("text"))
                edited = []
                for i in keep.tolist():
                    n = len(texts[i])
                    edited.append(texts[i][: n - n // 4] + texts[i + 1][: n // 4])
                changed = signature_sets(pa.array(edited, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("key").take(pa.array(keep)),
                        pa.array([len(texts[i]) for i in keep.tolist()], pa.int64()),
                        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                        pa.array([to_text(sets[i]) for i in keep.tolist()], pa.string()),
                        pa.array([to_text(s) for s in changed], pa.string()),
                        pa.array([likeness(sets[i], s) for i, s in zip(keep.tolist(), changed, strict=True)], pa.float64()),
                        pa.array([likeness(sets[i], sets[i + 1]) for i in keep.tolist()], pa.float64()),
                    ],
                    names=[f.split()[0] for f in EDITED.split(", ")],
                )

    return dealt.mapInArrow(run, EDITED)
