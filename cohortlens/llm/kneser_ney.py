"""Perplexity classifier: interpolated modified Kneser-Ney n-gram model of trusted text (operator 9).

The symbols are the bytes of the UTF-8 texts, all 256 of them, so no two texts look alike to the model; the separator
before a word that repeats the word before it is marked by a byte that UTF-8 never uses. The model is of order five. What
is gathered grows with the corpus and stays sharded: counts of all trusted documents are aggregated by task and summed by
n-gram, and turned into probabilities by joins on n-gram and context. Nothing of it goes to the driver.

Documents are scored in chunks of neighbouring doc_ids. Each chunk's distinct n-grams are packed by shard (a hash of the
n-gram) and meet the probabilities there; the answers go back to the chunk's texts. A task holds the distinct n-grams of
one chunk, or the model's of one shard; there is a shard for each gigabyte of text, and never fewer than 512. Steps are
stored, and what they shuffled is freed as soon as they are, so texts are on disk once at a time.

One trusted text in HELD_OUT (by a hash of the text, so copies stay together) is not counted. Documents are rejected
above a quantile of these unseen texts' bits per symbol in their language (a mergeable quantile sketch), widened by
``spread`` / sqrt(symbols) because short texts vary more. A language with fewer than ``min_trusted`` such documents takes
the limit of all languages.

Defined cases: null and empty texts have no symbols, no perplexity (null) and are rejected; null languages are a
language of their own; repeated rows are scored one by one; without trusted documents, or with none held out, every text
with symbols is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textkit as T
from cohortlens.llm.shared import compressed, dropped, freed_shuffles, of_ids, opened, stored
from cohortlens.session import cut_lineage

#: Order and bits of a symbol: of ``grams``, a small coding by classes of bytes, and of ``byte_grams``, the model's.
ORDER, BITS = 4, 6
BYTE_ORDER, BYTE_BITS = 5, 8
_REPEAT = 35
#: Neighbouring documents that are scored together; a text of more than LONG bytes is not put with its neighbours.
CHUNK, LONG = 2048, 1 << 18
#: Shards of the n-grams: so many at least, and one for so many bytes of text.
SHARDS, SHARD_BYTES = 512, 1 << 30
#: One trusted text in so many sets the limits in place of being counted.
HELD_OUT = 10
#: Distinct n-grams that a task gathers before it gives them out.
_HELD = 1 << 22
#: Working columns; named so that no column of a documents table clashes.
N_SYMBOLS, BITS_EACH, TOP, LANG, HELD = "__kn_symbols", "__kn_bits", "__kn_top", "__kn_lang", "__kn_held"
GROUP, KIND, KEYS, COSTS = "__kn_chunk", "__kn_kind", "__kn_keys", "__kn_costs"


def _alphabet() -> np.ndarray:
    code = np.full(256, 53, np.int32)  # controls
    for first, chars in ((1, range(ord("a"), ord("z") + 1)), (46, b"#*$%&|<")):
        code[list(chars)] = np.arange(first, first + len(chars))
    for c in range(ord("A"), ord("Z") + 1):
        code[c] = 27 + c % 4
    code[list(b"0123456789")] = 31
    for n, group in ((32, b" "), (33, b"\n"), (34, b"\t\r\v\f"), (36, b"."), (37, b","), (38, b"!"), (39, b"?"), (40, b";:"),
                     (41, b"'\"`"), (42, b"()[]{}"), (43, b"-_"), (44, b"/\\@"), (45, b"=+~^"), (52, b">")):
        code[list(group)] = n
    code[0x80:0xC0] = 54 + np.arange(64) % 8
    code[0xC0:0xE0], code[0xE0:] = 62, 63
    return code


_CODE = _alphabet()


def _marked(sym: np.ndarray, data: np.ndarray, offs: np.ndarray, mark: np.ndarray | int) -> np.ndarray:
    """``sym`` with the separator before each repeated word replaced by ``mark`` (one, or one for each byte)."""
    starts, ends, row = T.word_spans(data, offs)
    if len(starts) > 1:
        h = T.span_hashes(data, starts, ends)
        again = starts[np.flatnonzero((h[1:] == h[:-1]) & (row[1:] == row[:-1])) + 1] - 1
        sym[again] = mark if isinstance(mark, int) else mark[data[again]]
    return sym


def _rolled(sym: np.ndarray, offs: np.ndarray, order: int, bits: int, pad: int) -> np.ndarray:
    key = sym.copy()
    at = np.arange(len(sym)) - np.repeat(offs[:-1], np.diff(offs))
    for k in range(1, order):
        before = np.full(len(sym), pad, sym.dtype)
        before[k:] = np.where(at[k:] >= k, sym[:-k], pad)
        key |= before << (bits * k)
    return key


def grams(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The n-gram over classes of bytes that ends at each byte; a row's first ones are padded with symbol 0."""
    return _rolled(_marked(_CODE[data], data, offs, _REPEAT), offs, ORDER, BITS, 0)


#: Bytes that UTF-8 never uses: one for each separator before a repeated word, and the padding.
_SEPARATOR = np.zeros(256, np.int64)
_SEPARATOR[np.flatnonzero(T.WS)] = 0xF8 + np.arange(T.WS.sum())
_PAD = 0xFF


def byte_grams(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The n-gram over all bytes that ends at each byte; a row's first ones are padded with a byte that no text has."""
    return _rolled(_marked(data.astype(np.int64), data, offs, _SEPARATOR), offs, BYTE_ORDER, BYTE_BITS, _PAD)


def _shard(k: np.ndarray, shards: int) -> np.ndarray:
    return (T.mix(k.astype(np.uint64)) >> np.uint64(32)).astype(np.int64) % shards


def _pack(k: np.ndarray) -> bytes:
    """Sorted n-grams, as compressed differences."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(k, prepend=0).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(z: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.int64).ravel())


def _pack_costs(bits: np.ndarray) -> bytes:
    """Single-precision numbers, compressed a byte of each at a time."""
    return zstandard.ZstdCompressor(level=1).compress(bits.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack_costs(z: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view(np.float32).ravel()


def _types_task(shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, chunk, keys): the distinct n-grams of each chunk, packed by shard."""
    held: dict[int, list[np.ndarray]] = {}
    size = 0

    def given() -> Iterator[pa.RecordBatch]:
        for chunk, parts in held.items():
            k = np.unique(np.concatenate(parts))
            shard = _shard(k, shards)
            order = np.argsort(shard, kind="stable")
            full, first = np.unique(shard[order], return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), chunk, np.int64)),
                 pa.array([_pack(k[part]) for part in np.split(order, first[1:])], pa.binary())], names=["shard", GROUP, KEYS])

    for batch in batches:
        chunks = batch.column(GROUP).to_numpy()
        for lo, hi, data, offs in T.slices(batch.column("text")):
            k, n = byte_grams(data, offs), np.diff(offs)
            of = np.repeat(chunks[lo:hi], n)
            for chunk in np.unique(chunks[lo:hi][n > 0]).tolist():
                held.setdefault(chunk, []).append(np.unique(k[of == chunk]))
                size += len(held[chunk][-1])
        if size > _HELD:
            held = {c: [np.unique(np.concatenate(parts))] for c, parts in held.items()}
            size = sum(len(parts[0]) for parts in held.values())
            if size > _HELD // 2:
                yield from given()
                held, size = {}, 0
    yield from given()


def _distinct_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of rows sorted by shard; a shard at a time is held."""
    at, held, size = None, [], 0
    for batch in batches:
        for shard, z in zip(batch.column("shard").to_pylist(), batch.column(KEYS).to_pylist(), strict=True):
            if shard != at and held:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)))], names=["k"])
                held, size = [], 0
            at = shard
            held.append(_unpack(z))
            size += len(held[-1])
            if size > _HELD:
                held = [np.unique(np.concatenate(held))]
                size = 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)))], names=["k"])


def _counts_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        k, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        return k, np.bincount(at, np.concatenate([h[1] for h in held])).astype(np.int64)

    for batch in opened(batches):
        for _, _, data, offs in T.slices(batch.column("text")):
            held.append(np.unique(byte_grams(data, offs), return_counts=True))
        if sum(len(h[0]) for h in held) > _HELD:
            held = [merged()]
            if len(held[0][0]) > _HELD // 2:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["k", "n"])
                held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["k", "n"])


def _low(k: Column, order: int, bits: int) -> Column:
    return k.bitwiseAND(F.lit((1 << (bits * order)) - 1))


def discounts(t: tuple[int, int, int, int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of types seen once to four times; fixed ones where these don't suffice."""
    t1, t2, t3, t4 = t
    if min(t1, t2, t3) == 0:
        return 0.5, 1.0, 1.5
    y = t1 / (t1 + 2 * t2)
    raw = 1 - 2 * y * t2 / t1, 2 - 3 * y * t3 / t2, 3 - 4 * y * t4 / t3
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))


def probabilities(counts: DataFrame, types: DataFrame, top: int = ORDER, bits: int = BITS) -> DataFrame:
    """(k, p) for every type of ``types``: interpolated modified Kneser-Ney of order ``top`` from the n-gram
    ``counts`` (k, n) over symbols of ``bits`` bits."""
    tables = {top: counts}
    for order in range(top - 1, 0, -1):  # continuation counts: how many longer types end in this one
        tables[order] = stored(tables[order + 1].groupBy(_low(F.col("k"), order, bits).alias("k")).agg(F.count("*").alias("n")), "model")
    wanted = {top: types}
    for order in range(top - 1, 0, -1):
        wanted[order] = wanted[order + 1].select(_low(F.col("k"), order, bits).alias("k")).distinct()
    lower = None
    for order in range(1, top + 1):
        seen = tables[order]
        times = {r["n"]: r["t"] for r in seen.where("n <= 4").groupBy("n").agg(F.count("*").alias("t")).collect()}
        d1, d2, d3 = discounts(tuple(times.get(i, 0) for i in (1, 2, 3, 4)))
        n = F.col("n")
        cut = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        context = F.shiftright(F.col("k"), bits)
        shares = seen.groupBy(context.alias("c")).agg(F.sum("n").alias("total"), F.sum(F.least(cut, n)).alias("held"))
        out = (wanted[order].join(seen, "k", "left").withColumn("c", context).join(shares, "c", "left"))
        if lower is None:
            back = F.lit(2.0 ** -bits)
        else:
            out = out.withColumn("j", _low(F.col("k"), order - 1, bits)).join(lower.withColumnsRenamed({"k": "j", "p": "q"}), "j", "left")
            back = F.col("q")
        own = F.coalesce(F.greatest(n - cut, F.lit(0.0)), F.lit(0.0)) / F.col("total")
        out = out.select("k", F.coalesce(own + F.col("held") / F.col("total") * back, back).alias("p"))
        less, lower = lower, stored(out, "model")
        dropped(counts.sparkSession, [f for f in (less, seen) if f is not None and f is not counts])
    return lower


def held_out(text: str = "text") -> Column:
    """Whether a text, if it is trusted, sets the limits and is not counted."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(HELD_OUT)) == 0


def _chunk() -> Column:
    """The chunk of a row: any function of its doc_id and text will do, as both passes over the texts use it."""
    doc_id = F.col("doc_id").cast("long")
    near = F.coalesce(F.floor(doc_id / CHUNK), F.pmod(F.xxhash64("text"), F.lit(997)))
    return F.when(F.octet_length("text") > LONG, F.xxhash64(doc_id)).otherwise(near).cast("long")


def _priced_task(shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, k, bits) of the model's (k, p)."""
    for batch in batches:
        k = batch.column("k").to_numpy()
        bits = -np.log2(batch.column("p").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(_shard(k, shards).astype(np.int32)), pa.array(k), pa.array(bits)], names=["shard", "k", "bits"])


def _answer_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by shard, the model's (k, bits) first: the requests (chunk, keys) with the bits of their keys."""
    at, keys, costs, table = None, [], [], None
    for batch in batches:
        shard, kind = batch.column("shard").to_numpy(), batch.column(KIND).to_numpy()
        cut = np.append(np.flatnonzero(np.diff(shard * 2 + kind, prepend=-1)), len(shard))
        for lo, hi in zip(cut, cut[1:], strict=False):
            if shard[lo] != at:
                at, keys, costs, table = shard[lo], [], [], None
            part = batch.slice(lo, hi - lo)
            if kind[lo] == 0:
                keys.append(part.column("k").to_numpy())
                costs.append(part.column("bits").to_numpy())
                continue
            if table is None:
                k, c = np.concatenate(keys), np.concatenate(costs)
                order = np.argsort(k)
                table = k[order], c[order].astype(np.float32)
            found = [_pack_costs(table[1][np.searchsorted(table[0], _unpack(z))]) for z in part.column(KEYS).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(GROUP), part.column(KEYS), pa.array(found, pa.binary())],
                                             names=[GROUP, KEYS, COSTS])


def _scores_task(kept: list[str]):
    """From rows sorted by chunk, the bits of its n-grams first: the chunk's texts with their symbols and mean bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, costs, table = None, [], [], None
        for batch in batches:
            chunk, kind = batch.column(GROUP).to_numpy(), batch.column(KIND).to_numpy()
            new = np.ones(len(chunk), bool)
            new[1:] = (chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1])
            cut = np.append(np.flatnonzero(new), len(chunk))
            for lo, hi in zip(cut, cut[1:], strict=False):
                if chunk[lo] != at:
                    at, keys, costs, table = chunk[lo], [], [], None
                part = batch.slice(lo, hi - lo)
                if kind[lo] == 0:
                    keys += [_unpack(z) for z in part.column(KEYS).to_pylist()]
                    costs += [_unpack_costs(c) for c in part.column(COSTS).to_pylist()]
                    continue
                if table is None:
                    k, first = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_index=True)
                    table = k, np.concatenate([np.zeros(0, np.float32), *costs])[first]
                    keys, costs = [], []
                z = part.column("text")
                for some in opened(iter([part])):
                    for a, b, data, offs in T.slices(some.column("text")):
                        k, where = np.unique(byte_grams(data, offs), return_inverse=True)
                        cost = table[1][np.searchsorted(table[0], k)][where] if len(k) else np.zeros(0)
                        total = np.concatenate([[0.0], np.cumsum(cost, dtype=np.float64)])
                        n = np.diff(offs)
                        yield pa.RecordBatch.from_arrays(
                            [(z if c == "text" else some.column(c)).slice(a, b - a) for c in kept]
                            + [pa.array(n), pa.array((total[offs[1:]] - total[offs[:-1]]) / np.maximum(n, 1), mask=n == 0)],
                            names=[*kept, N_SYMBOLS, BITS_EACH])
                    z = z.slice(some.num_rows)
    return run


def answers(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(chunk, keys, costs): for every chunk of ``docs`` its distinct n-grams, packed, with their bits under the model of
    all documents whose doc_id is in ``trusted``, less those held out."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shards = max(SHARDS, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES))
    good = of_ids(texts.where(~held_out()), trusted.select(F.col("doc_id").cast("long")).distinct())
    with freed_shuffles(docs.sparkSession):
        counts = stored(good.select("text").mapInArrow(_counts_task, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")), "counts")
        asked = stored(texts.select(_chunk().alias(GROUP), "text").mapInArrow(
            functools.partial(_types_task, shards), f"shard int, {GROUP} long, {KEYS} binary"), "asked")
        types = stored(asked.select("shard", KEYS).repartition("shard").sortWithinPartitions("shard").mapInArrow(
            _distinct_task, "k long"), "types")
        model = probabilities(counts, types, BYTE_ORDER, BYTE_BITS)
        none = F.lit(None)
        priced = model.mapInArrow(functools.partial(_priced_task, shards), "shard int, k long, bits double").select(
            "shard", F.lit(0).alias(KIND), "k", "bits", none.cast("long").alias(GROUP), none.cast("binary").alias(KEYS))
        both = priced.unionByName(asked.select("shard", F.lit(1).alias(KIND), none.cast("long").alias("k"),
                                               none.cast("double").alias("bits"), GROUP, KEYS))
        found = stored(both.repartition("shard").sortWithinPartitions("shard", KIND).mapInArrow(
            _answer_task, f"{GROUP} long, {KEYS} binary, {COSTS} binary"), "answers")
    dropped(docs.sparkSession, [counts, asked, types, model])
    return found


def score(docs: DataFrame, priced: DataFrame, with_text: bool = False) -> DataFrame:
    """The rows of ``docs`` (texts, compressed, only if asked for) with their number of symbols and mean bits per symbol.
    Texts meet the ``answers`` of their chunk by a shuffle on the chunk."""
    rows = compressed(docs.withColumn(GROUP, _chunk()))
    fields = [f for f in rows.schema if f.name != GROUP]
    none = F.lit(None)
    texts = rows.select("*", F.lit(1).alias(KIND), none.cast("binary").alias(KEYS), none.cast("binary").alias(COSTS))
    first = priced.select(*[none.cast(f.dataType).alias(f.name) for f in fields], GROUP, F.lit(0).alias(KIND), KEYS, COSTS)
    kept = [f for f in fields if with_text or f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return first.unionByName(texts).repartition(GROUP).sortWithinPartitions(GROUP, KIND).mapInArrow(
        _scores_task([f.name for f in kept]), f"{schema}, {N_SYMBOLS} long, {BITS_EACH} double")


def limits(scores: DataFrame, trusted: DataFrame, quantile: float = 0.99, min_trusted: int = 30,
           accuracy: int = 10_000) -> tuple[DataFrame, float]:
    """((language, top), top of all): the quantile of the held-out trusted documents' bits per symbol."""
    marked = (scores.where((F.col(N_SYMBOLS) > 0) & F.col(HELD)).select("doc_id", "lang", BITS_EACH)
              .join(trusted.select(F.col("doc_id").cast("long")).distinct(), "doc_id", "left_semi"))
    sketch = [F.percentile_approx(BITS_EACH, quantile, accuracy).alias(TOP), F.count("*").alias("n")]
    own = marked.groupBy("lang").agg(*sketch).where(F.col("n") >= min_trusted).select(F.col("lang").alias(LANG), TOP)
    every = marked.agg(*sketch).first()[TOP]  # one number
    return cut_lineage(own), float("inf") if every is None else every


def _judged(scores: DataFrame, own: DataFrame, every: float, spread: float) -> tuple[DataFrame, Column]:
    limit = F.coalesce(F.col(TOP), F.lit(every)) + F.lit(spread) / F.sqrt(F.greatest(F.col(N_SYMBOLS), F.lit(1)))
    return scores.join(own, scores["lang"].eqNullSafe(own[LANG]), "left"), limit


def classify(docs: DataFrame, trusted: DataFrame, spread: float = 15.0) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold (both per symbol), kept; one row per document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"), held_out().alias(HELD))
    priced = answers(rows, trusted)
    with freed_shuffles(docs.sparkSession):
        scores = cut_lineage(score(rows, priced))
    dropped(docs.sparkSession, [priced])
    joined, limit = _judged(scores, *limits(scores, trusted), spread)
    return joined.select("doc_id", "lang", F.col(N_SYMBOLS).alias("n_symbols"), F.pow(F.lit(2.0), BITS_EACH).alias("perplexity"),
                         F.pow(F.lit(2.0), limit).alias("threshold"),
                         F.coalesce(F.col(BITS_EACH) <= limit, F.lit(False)).alias("kept"))


def _open_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in opened(batches):
        yield pa.RecordBatch.from_arrays([batch.column(c).cast(pa.string()) if c == "text" else batch.column(c) for c in batch.schema.names],
                                         names=batch.schema.names)


def keep_good(docs: DataFrame, trusted: DataFrame, spread: float = 15.0) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps. Texts are stored with their scores, so they travel once."""
    priced = answers(docs, trusted)
    with freed_shuffles(docs.sparkSession):
        scores = stored(score(docs.withColumn(HELD, held_out()), priced, with_text=True))
    dropped(docs.sparkSession, [priced])
    slim = scores.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), N_SYMBOLS, BITS_EACH, HELD)
    joined, limit = _judged(scores, *limits(slim, trusted), spread)
    kept = joined.where(F.col(BITS_EACH) <= limit).select(*[f"`{c}`" for c in docs.columns])
    return kept.mapInArrow(_open_task, ", ".join(
        f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema))
