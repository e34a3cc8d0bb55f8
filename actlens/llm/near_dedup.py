"""Near-duplicate detection: MinHash bands, sequential Bayesian verification and exact confirmation.

Every whole text gives a set of word shingles. ``BANDS`` x ``ROWS`` permutations band documents together; a pair
at similarity 0.8 is missed by all bands with probability (1 - 0.8^7)^48 = 1.2e-5. Candidates are compared in
batches of their one-byte signatures, and are dropped when the posterior probability that the similarity reaches
the threshold falls under ``MISS``; the survivors are confirmed on their full sets.

No group's pairs are spelled out. Equal sets are linked by digest. In each band bucket every document is first
tried against one hub (the smallest id), whose text goes once to each ``TEXTS`` documents that it is tried against;
what is linked is contracted to components. Only buckets that still hold several components are looked at again:
there, all pairs between components are compared inside blocks of about ``BLOCK`` signatures, so that no list, and no
task, grows with a bucket; a signature goes to one block in ``BLOCK`` others. What stays is held as lists of
candidates, by document and block of a component, and is confirmed block by block; one confirmed link to a
component's block is enough, so that the links kept grow with the documents and not with their pairs. These links
join components of the first graph, and only they are worked out again.

Digests, buckets, hubs and components may each hold a third of all rows: joins on them take the largest keys by
broadcast (``spread_join``), so that none of them meets in one task.

Defined cases: texts that are null or hold no word have an empty set and are linked with nothing; a text of fewer
words than a shingle is one shingle; ties are settled by the smallest id; repeated rows of one id are kept, each
with its component; a null id is linked with nothing and kept; other columns, whatever their names, pass by; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm.common import Scratch, arrow_map, column_of, components, largest, spread_join, texts_of

BANDS, ROWS = 48, 7
HASHES = BANDS * ROWS
BATCH = 48
MISS = 1e-5
BLOCK = 2048
#: Documents of a component whose texts are confirmed together.
TEXTS = 256
MEMO = 250_000
_draw = np.random.default_rng(20240607)
XORS = _draw.integers(0, 1 << 32, HASHES, np.uint32)
ODDS = _draw.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1)
SEEDS = _draw.integers(1, 1 << 63, BANDS, np.uint64)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    """Word -> 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def shingle_hashes(words: list[bytes], size: int, memo: WordHashes) -> np.ndarray:
    """The distinct 64-bit hashes of a word sequence's shingles, sorted."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    width = min(size, n)
    m = n - width + 1
    out = np.full(m, width, np.uint64)
    for k in range(width):
        out = (out ^ (out >> np.uint64(29))) * _M1 + h[k : m + k]
    out = (out ^ (out >> np.uint64(32))) * _M2
    return np.unique(out ^ (out >> np.uint64(29)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each permutation, as uint32."""
    x = ((hashes >> np.uint64(32)) ^ hashes).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 256):
        block = x[k : k + 256, None] ^ XORS
        block *= ODDS
        np.minimum(best, block.min(0), out=best)
    return best


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band for each signature; the band's number is part of its key."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(SEEDS, rows.shape[:2]).copy()
    for k in range(ROWS):
        keys = (keys ^ rows[:, :, k]) * _M1
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """For each number n of compared bytes the least number of matches with which a pair stays.

    With a uniform prior the posterior probability that the match rate is t or more, after m matches of n, is
    the chance of at most m successes in n + 1 trials of rate t. Bytes of unequal values match once in 256.
    """
    t = percent / 100 + (1 - percent / 100) / 256
    table = []
    for n in range(HASHES + 1):
        total, m = 0.0, -1
        while total < miss and m < n:
            m += 1
            total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(t) + (n + 1 - m) * math.log1p(-t))
        table.append(m if n else 0)
    return table


def plausible(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs left[i], right[j] those that stay through every batch of the sequential test."""
    matches = np.zeros(len(i), np.int32)
    for k in range(0, HASHES, BATCH):
        if not len(i):
            break
        matches += (left[i, k : k + BATCH] == right[j, k : k + BATCH]).sum(1, dtype=np.int32)
        stay = matches >= least[min(k + BATCH, HASHES)]
        i, j, matches = i[stay], j[stay], matches[stay]
    return i, j


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), HASHES)


def signed(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, sig binary, bands array<long>) of every row; keys and bands null for empty sets."""

    def make():
        memo = WordHashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_hashes(words_of(t), shingle, memo) for t in texts_of(batch, "text")]
            sizes = np.array([len(s) for s in sets], np.int64)
            full = sizes > 0
            signatures = np.array([signature(s) for s in sets if len(s)], np.uint32).reshape(-1, HASHES)
            keys, short = iter(band_keys(signatures)), iter(signatures.astype(np.uint8))
            digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            columns = [
                column_of(batch, "doc_id"),
                pa.array(sizes),
                pa.array(digest, pa.binary()),
                pa.array([next(short).tobytes() if f else None for f in full], pa.binary()),
                pa.array([next(keys) if f else None for f in full], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_key", "sig", "bands"])

        return step

    return arrow_map(docs.select("doc_id", "text"), make, "doc_id long, n_shingles long, set_key binary, sig binary, bands array<long>")


def marked(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``rows`` with ``__hit``: false only where the key is not among ``ids`` (one column).

    A bitmap of hashed ids, of a size fixed by their number and 8 MB at most, is joined by broadcast. When it is too
    small for the ids more rows are hit, which costs a later join work but changes nothing.
    """
    n = ids.count()
    size = 1 << min(26, max(15, (32 * max(1, n)).bit_length()))
    place = F.pmod(F.xxhash64("__id"), F.lit(size))
    ends = ids.toDF("__id").select(place.alias("p"))
    maps = ends.groupBy(F.expr("p div 32768").alias("__part")).agg(F.expr("bitmap_construct_agg(p % 32768)").alias("__map"))
    placed = rows.withColumn("__id", F.col(key)).withColumn("__p", place).withColumn("__part", F.expr("__p div 32768"))
    bit = F.expr("shiftright(cast(conv(hex(substring(__map, cast((__p % 32768) div 8 as int) + 1, 1)), 16, 10) as int), cast(__p % 8 as int)) & 1")
    return placed.join(F.broadcast(maps), "__part", "left").select(*rows.columns, F.coalesce(bit == 1, F.lit(False)).alias("__hit"))


def only(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose key is among ``ids``, and a few others: a filter ahead of a shuffle."""
    return marked(rows, key, ids).where("__hit").drop("__hit")


def without(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose key is not among ``ids``; only rows that the bitmap hits are shuffled."""
    flagged = marked(rows, key, ids)
    unsure = flagged.where("__hit").drop("__hit").join(ids.toDF("__gone"), F.col(key) == F.col("__gone"), "left_anti")
    return flagged.where("not __hit").drop("__hit").unionAll(unsure)


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select("a").unionAll(pairs.select("b"))


def probable(scratch: Scratch, pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Of candidate pairs (a, b) those that pass the sequential test."""
    few = only(sigs.where("sig is not null").select("doc_id", "sig"), "doc_id", ends_of(pairs))
    hubs = scratch.put(pairs.groupBy("b").agg(F.count("*").alias("n")).join(few.toDF("b", "sig_b"), "b"))
    both = spread_join(pairs.join(few.toDF("a", "sig_a"), "a"), hubs, ["b"])

    def make():
        least = least_matches(percent)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = np.arange(batch.num_rows)
            i, _ = plausible(matrix(column_of(batch, "sig_a")), matrix(column_of(batch, "sig_b")), at, at, least)
            return pa.RecordBatch.from_arrays([column_of(batch, "a").take(pa.array(i)), column_of(batch, "b").take(pa.array(i))], ["a", "b"])

        return step

    return scratch.put(arrow_map(both.select("a", "b", "sig_a", "sig_b"), make, "a long, b long"))


def shingle_set(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    width = min(size, len(words))
    return set(zip(*[words[k:] for k in range(width)], strict=False)) if width else set()


def confirmed(scratch: Scratch, pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Of the pairs (a, hub b) those whose full sets reach the similarity: 100 * intersection >= percent * union."""
    few = only(docs.select("doc_id", "text").where("doc_id is not null"), "doc_id", ends_of(pairs))
    hubs = scratch.few(pairs.groupBy("b").agg(F.count("*").alias("n"), F.expr(f"cast(ceil(count(*) / {TEXTS}) as int)").alias("m")))
    placed = spread_join(pairs, hubs, ["b"]).select("a", "b", F.expr("cast(pmod(xxhash64(a), m) as int)").alias("k"))
    tried = placed.join(few.toDF("a", "text"), "a").groupBy("b", "k").agg(F.collect_list(F.struct("a", "text")).alias("tried"))
    texts = hubs.join(few.toDF("b", "hub"), "b").select("b", F.explode(F.expr("sequence(0, m - 1)")).alias("k"), "hub")
    both = tried.join(texts, ["b", "k"]).select("b", "hub", "tried")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            links: list[tuple[int, int]] = []
            for b, hub, tried in zip(*[column_of(batch, c).to_pylist() for c in ("b", "hub", "tried")], strict=True):
                two = shingle_set(words_of(hub or ""), shingle)
                for x in tried:
                    one = shingle_set(words_of(x["text"] or ""), shingle)
                    common = len(one & two)
                    if common and 100 * common >= percent * (len(one) + len(two) - common):
                        links.append((x["a"], b))
            return pa.RecordBatch.from_arrays([pa.array([x[c] for x in links], pa.int64()) for c in (0, 1)], ["a", "b"])

        return step

    return scratch.put(arrow_map(both, make, "a long, b long", rows=8).distinct())


def across(scratch: Scratch, buckets: DataFrame, percent: int) -> DataFrame:
    """(probe, comp, sub, cands): for documents of buckets with several components the plausible partners elsewhere.

    ``buckets`` has (bucket, doc_id, comp, sub, set_key, sig), mixed buckets only. Base rows are all documents and
    probe rows those outside the component of the smallest number; both are dealt into blocks, and each probe block
    meets each base block in one row.
    """
    # equal sets are in one component and have equal signatures: one of them speaks for all
    rows = buckets.groupBy("bucket", "comp", "set_key").agg(F.min(F.struct("doc_id", "sub", "sig")).alias("m")).select("bucket", "comp", "m.*")
    counts = rows.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("bucket").agg(F.min(F.struct("comp", "n")).alias("low"), F.sum("n").alias("n"))
    sizes = sizes.select("bucket", "n", F.col("low.comp").alias("low"), F.expr(f"cast(ceil((n - low.n) / {BLOCK}) as int)").alias("pm"), F.expr(f"cast(ceil(n / {BLOCK}) as int)").alias("bm"))
    rows = spread_join(rows, scratch.few(sizes), ["bucket"]).where("pm > 0")
    own = F.expr("cast(pmod(xxhash64(doc_id), bm) as int)")
    mine = F.expr("cast(pmod(xxhash64(doc_id, 1), pm) as int)")
    cell = F.struct("doc_id", "comp", "sub", "sig")
    bases = rows.select("bucket", F.explode(F.expr("sequence(0, pm - 1)")).alias("p"), own.alias("c"), F.lit(False).alias("probe"), cell.alias("cell"))
    probes = rows.where("comp <> low").select("bucket", mine.alias("p"), F.explode(F.expr("sequence(0, bm - 1)")).alias("c"), F.lit(True).alias("probe"), cell.alias("cell"))
    blocks = bases.unionAll(probes).groupBy("bucket", "p", "c").agg(F.expr("collect_list(cell) filter (where not probe)").alias("bases"), F.expr("collect_list(cell) filter (where probe)").alias("probes"))

    def make():
        least = least_matches(percent)

        def parts(cells: list[dict]) -> tuple[np.ndarray, ...]:
            numbers = [np.array([x[c] for x in cells], np.int64) for c in ("doc_id", "comp", "sub")]
            return *numbers, np.frombuffer(b"".join(x["sig"] for x in cells), np.uint8).reshape(-1, HASHES)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found: dict[tuple[int, int, int], list[int]] = {}
            for bases, probes in zip(column_of(batch, "bases").to_pylist(), column_of(batch, "probes").to_pylist(), strict=True):
                if not bases or not probes:
                    continue
                (b_id, b_comp, b_sub, b_sig), (p_id, p_comp, _, p_sig) = parts(bases), parts(probes)
                for k in range(0, len(p_id), 64):
                    i, j = np.nonzero(p_comp[k : k + 64, None] != b_comp[None, :])
                    i, j = plausible(p_sig, b_sig, i + k, j, least)
                    for x, y in zip(i.tolist(), j.tolist(), strict=True):
                        found.setdefault((int(p_id[x]), int(b_comp[y]), int(b_sub[y])), []).append(int(b_id[y]))
            keys = list(found)
            columns = [pa.array([k[c] for k in keys], pa.int64()) for c in range(3)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([found[k] for k in keys], pa.list_(pa.int64()))], ["probe", "comp", "sub", "cands"])

        return step

    found = arrow_map(blocks.select("bases", "probes"), make, "probe long, comp long, sub long, cands array<long>", rows=16)
    # a block holds about TEXTS documents, so that its list of candidates is short
    return found.groupBy("probe", "comp", "sub").agg(F.array_distinct(F.flatten(F.collect_list("cands"))).alias("cands"))


def confirmed_blocks(scratch: Scratch, found: DataFrame, members: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) of probes to components, by full sets; of each block of a component one link a probe is enough.

    ``members`` has (doc_id, comp, sub): the documents of each block.
    """
    counts = scratch.few(found.groupBy("comp", "sub").agg(F.count("*").alias("n"), F.expr(f"cast(ceil(count(*) / {TEXTS}) as int)").alias("m")))
    held = scratch.few(members.join(counts.select("comp", "sub", "m"), ["comp", "sub"]))
    needed = held.select("doc_id").unionAll(found.select(F.col("probe").alias("doc_id"))).distinct()
    texts = only(docs.select("doc_id", "text").where("doc_id is not null"), "doc_id", needed)
    blocks = held.join(texts, "doc_id").groupBy("comp", "sub", "m").agg(F.collect_list(F.struct("doc_id", "text")).alias("docs"))
    blocks = blocks.select("comp", "sub", F.explode(F.expr("sequence(0, m - 1)")).alias("k"), "docs")
    dealt = spread_join(found, counts, ["comp", "sub"]).withColumn("k", F.expr("cast(pmod(xxhash64(probe), m) as int)"))
    probes = dealt.join(texts.withColumnRenamed("doc_id", "probe"), "probe")
    probes = probes.groupBy("comp", "sub", "k").agg(F.collect_list(F.struct("probe", "cands", "text")).alias("probes"))
    both = probes.join(blocks, ["comp", "sub", "k"]).select("comp", "probes", "docs")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            links: list[tuple[int, int]] = []
            for comp, probes, docs in zip(*[column_of(batch, c).to_pylist() for c in ("comp", "probes", "docs")], strict=True):
                sets = {x["doc_id"]: shingle_set(words_of(x["text"] or ""), shingle) for x in docs}
                for p in probes:
                    one = shingle_set(words_of(p["text"] or ""), shingle)
                    for c in p["cands"]:
                        two = sets.get(c, ())
                        # sizes alone can rule a pair out
                        if min(len(one), len(two)) * 100 < percent * max(len(one), len(two)):
                            continue
                        common = len(one & two)
                        if common and 100 * common >= percent * (len(one) + len(two) - common):
                            links.append((p["probe"], comp))
                            break
            return pa.RecordBatch.from_arrays([pa.array([x[c] for x in links], pa.int64()) for c in (0, 1)], ["a", "b"])

        return step

    return scratch.put(arrow_map(both, make, "a long, b long", rows=8).distinct())


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; kept is the document with the component's smallest id."""
    scratch = scratch or Scratch(docs.sparkSession, "near")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sigs = scratch.put(signed(docs, shingle))
    named = sigs.where("set_key is not null and doc_id is not null")
    # equal sets, and candidates: each document with the hub of each of its buckets
    first = scratch.few(named.groupBy("set_key").agg(F.min("doc_id").alias("b"), F.count("*").alias("n")).where("n > 1"))
    same = scratch.few(spread_join(named.select("set_key", F.col("doc_id").alias("a")), first, ["set_key"]).where("a <> b").select("a", "b"))
    buckets = named.select(F.explode("bands").alias("bucket"), "doc_id")
    hubs = scratch.few(buckets.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).where("n > 1"))
    shared = scratch.few(spread_join(buckets, hubs, ["bucket"]))
    stars = shared.where("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct().join(same, ["a", "b"], "left_anti")
    stars = scratch.few(stars)
    likely = probable(scratch, stars, sigs, percent)
    found = scratch.few(components(scratch, confirmed(scratch, likely, docs, shingle, percent).unionAll(same)))
    # only documents that are in buckets of several components are needed with their signatures
    sizes = scratch.few(found.groupBy("component").agg(F.count("*").alias("n"), F.expr(f"ceil(count(*) / {TEXTS})").alias("m")))
    placed = spread_join(found, sizes, ["component"]).select(F.col("node").alias("doc_id"), F.col("component").alias("comp"), F.expr("pmod(xxhash64(node), m)").alias("sub"))
    named_buckets = shared.select("bucket", "doc_id").join(placed, "doc_id", "left").select("bucket", "doc_id", F.coalesce("comp", "doc_id").alias("comp"), F.coalesce("sub", F.lit(0)).cast("long").alias("sub"))
    named_buckets = scratch.few(named_buckets)
    scratch.drop(shared, first, hubs, stars, likely)
    mixed = named_buckets.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n")).where("low < high").select("bucket", "n")
    left = scratch.few(spread_join(named_buckets, scratch.few(mixed), ["bucket"]))
    members = scratch.few(left.select("doc_id", "comp", "sub").distinct())
    keyed = only(named.select("doc_id", "set_key", "sig"), "doc_id", members.select("doc_id"))
    partners = scratch.put(across(scratch, left.join(keyed, "doc_id"), percent))
    scratch.drop(named_buckets, left)
    links = confirmed_blocks(scratch, partners, members, docs, shingle, percent)
    ends = links.join(members.select(F.col("doc_id").alias("a"), F.col("comp").alias("__of")), "a").select(F.col("__of").alias("a"), "b").distinct()
    merged = scratch.few(components(scratch, ends).toDF("comp", "component_id"))
    scratch.drop(partners, members)
    out = sigs.where("doc_id is not null").select("doc_id", "n_shingles").join(found.toDF("doc_id", "comp"), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
    # the largest components by broadcast; all others are joined
    large = largest(sizes, ["component"]).select(F.col("component").alias("comp")).join(merged, "comp", "left").select("comp", F.coalesce("component_id", "comp").alias("component_id"))
    here = out.join(F.broadcast(large), "comp")
    rest = out.join(F.broadcast(large.select("comp")), "comp", "left_anti").join(merged, "comp", "left")
    bare = sigs.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("comp"), F.lit(None).cast("long").alias("component_id"))
    out = here.unionByName(rest).unionByName(bare)
    component = F.coalesce("component_id", "comp")
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (with doc_id and text) that near-duplicate detection keeps, with their own columns."""
    spark = docs.sparkSession
    work = Scratch(spark, "near")
    found = near_duplicates(docs, shingle, percent, scratch=work)
    gone = Scratch(spark, "gone").few(found.where("not kept").select(F.col("doc_id").alias("__gone")).distinct())
    work.clear()
    return without(docs, "doc_id", gone).select(*docs.columns)
