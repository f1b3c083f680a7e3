"""Phrases that stand together more often than their parts, counted over a prefix-free parse.

Texts are split into pieces at punctuation and line ends, pieces into words. Where a hash of ``max_words - 1`` neighbouring words is divisible by
``modulus``, a chunk ends with them and the next begins with them: where text repeats, so do its chunks, whatever stands before.
The distinct chunks with their frequencies are the dictionary. N-grams of up to ``max_words`` words are counted inside the distinct chunks only,
weighted by the frequency. Chunks overlap by one word less than the longest n-gram, so each n-gram lies within one; an n-gram that lies within
the overlap alone counts in the chunk before (one is counted where its last word stands beyond the chunk's leading overlap). Chunks without a trigger
are ended after ``max_chunk`` words, with the same overlap, which changes no count.

A phrase found ``min_count`` times has parts found as often, so counting goes by length: an n-gram is counted only if the two
n-grams of one word less in it are frequent. That is looked up in a bit set of the frequent ones' hashes, of bounded size (``filter_bits``): a false hit
costs a row that the sum then drops, nothing is lost. Each task counts about ``words`` words before it sends sums; what it holds does not grow
with its partition. Sums are exact integers, scores exact decimals. The dictionary and the counts of frequent n-grams are written to the shared folder.

Single words are counted as text, each with a key: a 64-bit hash of its language and itself. Longer n-grams are counted, joined and scored by the keys
of their words, and get their text last. That is exact, as the count of single words, which sees all of them, also finds keys that two words share;
then it is made anew with other keys.

A language that is null is ``und``. Null and empty texts have no words. Repeated rows count each time. Ties in score go by count, then by
the phrase's bytes. Columns other than ``lang`` and ``text`` are ignored. Empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from obslake.llm.common import mix
from obslake.session import new_shared_path

#: What ends a piece, and what stands between words.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

_CLEAN = bytes(10 if c in ENDS else 32 if c in BLANKS else c for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64)
_LONG = 64  # words beyond so many bytes are hashed byte by byte from there
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of the first n of eight bytes


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hashes of the slices ``starts:ends``, by their bytes alone; each salt gives others."""
    size = ends - starts
    out = mix(size.astype(np.uint64), salt)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    some = np.flatnonzero(size > 0)
    for place in range(0, _LONG, 8):
        part = eight[starts[some] + place] & _FIRST[np.minimum(size[some] - place, 8)]
        out[some] = mix(out[some] * _ODD + part)
        some = some[size[some] > place + 8]
        if not len(some):
            return out
    # the rest of long ones, all at once: each byte with its place, mixed, and their sum
    start, size = starts[some] + _LONG, size[some] - _LONG
    at = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(at, size)
    terms = mix(_BYTE[data[np.repeat(start, size) + place]] + place.astype(np.uint64) * _ODD, salt)
    out[some] = mix(out[some] * _ODD + np.add.reduceat(terms, at))
    return out


def _run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbouring hashes."""
    out = hashes[:max(0, len(hashes) - width + 1)]
    for i in range(1, width):
        out = mix(out * _ODD + hashes[i:len(hashes) - width + 1 + i])
    return out


def parse(texts: list[str], overlap: int, modulus: int, max_chunk: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Chunks of all texts, words joined by single blanks: bytes, the text each is of, whether it begins with an overlap."""
    cleaned = [t.encode().lower().translate(_CLEAN) for t in texts]
    data = np.frombuffer(b"\n".join(cleaned) + b"\n", np.uint8)
    text_ends = np.cumsum([len(c) + 1 for c in cleaned])
    word = (data != 32) & (data != 10)
    edge = np.diff(word.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return [], np.empty(0, np.int64), np.empty(0, bool)
    lines = np.flatnonzero(data == 10)
    piece = np.searchsorted(lines, starts)
    new = np.flatnonzero(np.diff(piece, prepend=-1))  # the first word of each piece
    first = np.repeat(new, np.diff(new, append=len(starts)))  # of each word: its piece's first and last
    last = np.repeat(np.append(new[1:], len(starts)) - 1, np.diff(new, append=len(starts)))
    begins = np.zeros(len(starts), bool)
    begins[new] = True
    if overlap:
        runs = _run_hashes(_word_hashes(data, starts, ends), overlap)
        at = np.flatnonzero(runs % np.uint64(modulus) == 0)
        begins[at[(at > first[at]) & (at + overlap - 1 < last[at])]] = True
    else:
        begins[:] = True
    chunk = np.flatnonzero(begins)
    stop = np.minimum(np.append(chunk[1:], len(starts)) - 1 + overlap, last[chunk])  # the last word of each chunk
    long = np.flatnonzero(np.append(chunk[1:], len(starts)) - chunk > max_chunk)
    if len(long):
        more = [np.arange(chunk[i] + max_chunk, stop[i] - overlap + 1, max_chunk) for i in long.tolist()]
        chunk = np.sort(np.concatenate([chunk, *more]))
        stop = np.minimum(np.append(chunk[1:], len(starts)) - 1 + overlap, last[chunk])
    # words followed by one byte each, in one buffer
    kept = word | (edge == -1)
    size = ends - starts
    at = np.cumsum(size + 1) - size - 1
    buffer = data[kept].copy()
    buffer[at + size] = 32
    flat = buffer.tobytes()
    chunks = [flat[a:b] for a, b in zip(at[chunk].tolist(), (at[stop] + size[stop]).tolist())]
    return chunks, np.searchsorted(text_ends, starts[chunk], side="right"), chunk > first[chunk]


def dictionary(docs: DataFrame, overlap: int, modulus: int, max_chunk: int) -> DataFrame:
    """Distinct chunks: lang, inner (begins with an overlap), chunk, times."""

    def run(it):
        for batch in it:
            texts, langs = batch["text"].to_pylist(), batch["lang"]
            sizes, start, held = [len(t) for t in texts], 0, 0
            for i in range(len(texts) + 1):
                if i == len(texts) or held and held + sizes[i] > 1 << 21:
                    chunks, of, inner = parse(texts[start:i], overlap, modulus, max_chunk)
                    for j in range(0, len(chunks), 1 << 15):
                        part = slice(j, j + (1 << 15))
                        yield pa.RecordBatch.from_arrays([
                            langs.take(pa.array(of[part] + start)), pa.array(inner[part]), pa.array(chunks[part], pa.binary()).cast(pa.string())],
                            ["lang", "inner", "chunk"])
                    start, held = i, 0
                if i < len(texts):
                    held += sizes[i]

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = rows.where("text != ''").mapInArrow(run, "lang string, inner boolean, chunk string")
    return chunks.groupBy("lang", "inner", "chunk").agg(F.count("*").alias("times"))


# --- counting ----------------------------------------------------------------------------------------


class BitSet:
    """Hashes that may be in a set: two bits for each, in a power of two of bits."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    @staticmethod
    def places(hashes: np.ndarray, mask: np.uint64) -> list[np.ndarray]:
        return [hashes & mask, (hashes >> np.uint64(32)) & mask]

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in self.places(hashes, self.mask):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of an array of strings."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), bounds[:-1], bounds[1:]


def _text_hashes(column: pa.Array, salt: int = 0) -> np.ndarray:
    return _word_hashes(*_flat(column), salt)


class _Counter:
    """N-grams of one length in chunks, summed up over many chunks at once."""

    def __init__(self, n: int, overlap: int, frequent: BitSet | None, salt: int, key_bits: int) -> None:
        self.n, self.overlap, self.frequent, self.salt = n, overlap, frequent, salt
        self.key_mask = np.uint64((1 << key_bits) - 1)

    def count(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Rows (k1, ..., f); for single words (k1, lang, phrase, f), with the sum of all of a language, its key and phrase null."""
        n = self.n
        table = table.combine_chunks()
        lang = table["lang"].combine_chunks().dictionary_encode()
        lists = pc.split_pattern(table["chunk"].combine_chunks().cast(pa.large_string()), " ")
        words = lists.flatten().dictionary_encode()
        entries = words.dictionary
        code = words.indices.to_numpy().astype(np.int64)
        size = np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(code)) - (np.cumsum(size) - size)[owner]
        of_lang = lang.indices.to_numpy().astype(np.int64)
        n_langs = len(lang.dictionary)
        # the last words of n-grams that are this chunk's own
        last = np.flatnonzero((place >= n - 1) & ((place >= self.overlap) | ~np.asarray(table["inner"])[owner]))
        del place
        times = table["times"].to_numpy()
        word = code * n_langs + of_lang[owner]
        word_hashes, lang_hashes = _text_hashes(entries, self.salt), _text_hashes(lang.dictionary, self.salt)

        def keys(of: np.ndarray) -> np.ndarray:
            return mix(lang_hashes[of % n_langs] * _ODD + word_hashes[of // n_langs]) & self.key_mask

        if n == 1:
            total = np.bincount(of_lang[owner[last]], times[owner[last]], n_langs).astype(np.int64)  # exact below 2**53 in one batch
            yield self._rows([pa.nulls(n_langs, pa.int64()), lang.dictionary, pa.nulls(n_langs, pa.string())], total)
        if self.frequent is not None:
            holds = self.frequent.holds(_run_hashes(keys(word), n - 1))  # runs across two chunks are never looked up
            last = last[holds[last - (n - 1)] & holds[last - (n - 2)]]
        key, span = word[last], len(entries) * n_langs
        for i in range(1, n):
            if span > (1 << 62) // len(entries):
                found, key = np.unique(key, return_inverse=True)
                span = len(found)
            key, span = key * len(entries) + code[last - i], span * len(entries)
        order = np.argsort(key)
        key = key[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        sums = np.add.reduceat(times[owner[last]][order], new) if len(new) else np.empty(0, np.int64)
        some = last[order[new]]
        for i in range(0, len(some), 1 << 16):
            part = some[i:i + (1 << 16)]
            columns = [pa.array(keys(word[part - (n - 1) + j]).view(np.int64)) for j in range(n)]
            if n == 1:
                columns += [lang.dictionary.take(pa.array(of_lang[owner[part]])), entries.take(pa.array(code[part])).cast(pa.string())]
            yield self._rows(columns, sums[i:i + (1 << 16)])

    def _rows(self, columns: list[pa.Array], f: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*columns, pa.array(f, pa.int64())], [*(["k1", "lang", "phrase"] if self.n == 1 else _keys(self.n)), "f"])


def _keys(n: int, start: int = 1) -> list[str]:
    return [f"k{i}" for i in range(start, start + n)]


def _counted(chunks: DataFrame, n: int, overlap: int, frequent, min_count: int, words: int, salt: int, key_bits: int) -> DataFrame:
    """Frequent n-grams of ``n`` words: k1, ..., f; single words as k1, lang, phrase, f, same, also their number by lang, its key and phrase null.

    ``same`` is the number of words, rare ones too, that have this key. Tasks send each n-gram once for many chunks, so sums begin after the exchange.
    """

    def run(it):
        counter = _Counter(n, overlap, BitSet(frequent.value) if frequent is not None else None, salt, key_bits)
        held, size = [], 0
        for batch in it:
            held.append(batch)
            size += batch["chunk"].nbytes // 6
            if size >= words:
                yield from counter.count(pa.Table.from_batches(held))
                held, size = [], 0
        if held and size:
            yield from counter.count(pa.Table.from_batches(held))

    if n > 1:
        rows = chunks.mapInArrow(run, ", ".join(f"{k} long" for k in [*_keys(n), "f"])).repartition(*_keys(n))
        return rows.groupBy(*_keys(n)).agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
    rows = chunks.mapInArrow(run, "k1 long, lang string, phrase string, f long").repartition("k1")
    sums = rows.groupBy("k1", "lang", "phrase").agg(F.sum("f").alias("f"))
    sums = sums.withColumn("same", F.count("phrase").over(Window.partitionBy("k1")))
    return sums.where((F.col("f") >= min_count) | F.col("phrase").isNull() | (F.col("same") > 1))


def _bit_set(spark: SparkSession, counts: DataFrame, n: int, filter_bits: int):
    """A broadcast bit set of frequent n-grams: 16 bits for each, at most ``filter_bits`` in all."""
    counts = counts.where("k1 is not null").select(*_keys(n))
    bits = min(filter_bits, 1 << max(6, (16 * counts.count()).bit_length()))
    mask = np.uint64(bits - 1)

    def run(it):
        for batch in it:
            h = batch["k1"].to_numpy().view(np.uint64)
            for k in _keys(n - 1, 2):
                h = mix(h * _ODD + batch[k].to_numpy().view(np.uint64))
            at = np.unique(np.concatenate(BitSet.places(h, mask)))
            slot, first = np.unique((at >> np.uint64(6)).astype(np.int64), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(first) else at
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(value.view(np.int64))], ["slot", "bits"])

    slots = counts.mapInArrow(run, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    found = slots.toArrow()  # at most filter_bits / 64 rows
    out = np.zeros(bits // 64, np.uint64)
    out[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(out)


def key_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, modulus: int = 16, max_chunk: int = 1_024,
               words: int = 1 << 21, filter_bits: int = 1 << 27, key_bits: int = 64) -> list[DataFrame]:
    """For 1 to ``max_words`` words: all n-grams found at least ``min_count`` times, written to the shared folder.

    Single words as k1, lang, phrase, f, and the number of all words of each language, its key and phrase null; longer n-grams as the keys
    of their words (k1, k2, ...) and f. Keys have ``key_bits`` bits; where two words share one, 64 bits with another salt, until none do.
    """
    spark = docs.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = new_shared_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    overlap = max_words - 1
    chunks = written(dictionary(docs, overlap, modulus, max_chunk), "chunks")
    salt = 0
    singles = written(_counted(chunks, 1, overlap, None, min_count, words, salt, key_bits), "phrases-1")
    while not singles.where("same > 1").isEmpty():
        salt, key_bits = salt + 1, 64
        singles = written(_counted(chunks, 1, overlap, None, min_count, words, salt, key_bits), "phrases-1")
    out = [singles.drop("same")]
    for n in range(2, max_words + 1):
        frequent = _bit_set(spark, out[-1], n - 1, filter_bits)
        out.append(written(_counted(chunks, n, overlap, frequent, min_count, words, salt, key_bits), f"phrases-{n}"))
    return out


def _with_words(rows: DataFrame, singles: DataFrame, n: int) -> DataFrame:
    """``rows`` with their lang, the words of their ``n`` keys (w1, ...) and how often each of these was found (f1, ...)."""
    for i in range(1, n + 1):
        lang = ["lang"] if i == 1 else []
        rows = rows.join(singles.select(F.col("k1").alias(f"k{i}"), F.col("phrase").alias(f"w{i}"), F.col("f").alias(f"f{i}"), *lang), f"k{i}")
    return rows


def _phrase(n: int):
    return F.concat_ws(" ", *(f"w{i}" for i in range(1, n + 1)))


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, **parsing) -> list[DataFrame]:
    """For 1 to ``max_words`` words: lang, phrase, f of all phrases found at least ``min_count`` times.

    The first also holds the number of all words of each language, its phrase null.
    """
    counts = key_counts(docs, max_words, min_count, **parsing)
    longer = [_with_words(c, counts[0], n).select("lang", _phrase(n).alias("phrase"), "f") for n, c in enumerate(counts[1:], 2)]
    return [counts[0].select("lang", "phrase", "f"), *longer]


def mine(docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2_000, **parsing) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words by language: lang, rank, phrase, a, l, r, n, score."""
    counts = key_counts(docs, max_words, min_count, **parsing)
    n_words = counts[0].where("phrase is null").select("lang", F.col("f").alias("n"))
    singles = counts[0].where("phrase is not null")
    out = []
    for size in range(2, max_words + 1):
        rows = counts[size - 1].withColumnRenamed("f", "a")
        if size < max_words:  # a longer phrase that holds this one as often has one of one word more in it
            parts = [counts[size].select(*(F.col(k).alias(to) for k, to in zip(_keys(size, s), _keys(size))), "f") for s in (1, 2)]
            parts = reduce(DataFrame.union, parts).groupBy(*_keys(size)).agg(F.max("f").alias("longer"))
            rows = rows.join(parts, _keys(size), "left").where("longer is null or 100 * longer < 50 * a").drop("longer")
        rows = _with_words(rows, singles, size)
        scores = []
        for k in range(1, size):
            for name, start, n in (("l", 1, k), ("r", k + 1, size - k)):
                if n == 1:
                    rows = rows.withColumn(name, F.col(f"f{start}"))
                else:
                    part = counts[n - 1].select(*(F.col(key).alias(to) for key, to in zip(_keys(n), _keys(n, start))), F.col("f").alias(name))
                    rows = rows.join(part, _keys(n, start))
            # l and r are at least a, so the quotient is at most a million
            score = F.expr("(cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * 1000000bd) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
            rows = rows.withColumn(f"cut{k}", F.struct(score.alias("score"), F.lit(k).alias("k"), "l", "r")).drop("l", "r")
            scores.append(F.col(f"cut{k}"))
        best = F.array_min(F.array(*scores)) if size > 2 else scores[0]
        out.append(rows.select("lang", _phrase(size).alias("phrase"), "a", best.alias("cut")))
    found = reduce(DataFrame.union, out).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    return ranked.join(n_words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
