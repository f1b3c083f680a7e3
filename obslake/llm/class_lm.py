"""Class-based n-grams: exchange clustering gives words classes; class transitions times word emissions score a text.

Words are lower-cased (A-Z) and separated by blanks; every text ends with one end token. Spark counts all words of the
learning rows, and all steps between the ``clustered`` most frequent words, the rest and the end. Exchange
clustering moves each of these words to the class that raises the likelihood of the steps most, until a round moves few
or ``sweeps`` are over; its input is a matrix of ``clustered`` words by as many, whatever the corpus is. Every other learning word
then gets the class under which the classes before and after it are likeliest, from its counts of both. Steps between classes
are counted over all words. Then

    P(text) = product of P(class | class before) * P(word | class),

transitions smoothed towards the classes' shares, emissions by count. Words that learning has not seen are a class of their own, the rest,
one unknown word whose chance is about that of the baseline. The unigram baseline is (c + 1) / (N + V + 1).

One pass sends the most frequent words (at most ``sent``, of at most 64 bytes each, cut at a count from a histogram) to the tasks and keeps
of each row its steps between classes. Any other word leaves the pass with the classes beside it and meets its own class and count in a
join; two such words in a row leave it as a pair too. Counts and classes cover the whole corpus, and no short learning word in that join is
frequent in it. What one step hands to the next is written as Parquet to the shared folder and removed once it is used up; a word's contexts
travel packed, one row per word and task.

Null and empty texts are the end token alone. Repeated rows are scored one by one and learnt from each time. Only ``doc_id`` and
``text`` are read. Without learning rows N and V are 0 and the baseline gives every token the same chance.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from obslake.llm.common import RowIds, batches, crc_remainder, remove, texts
from obslake.session import new_shared_path

_FLUSH = 400_000  # different words a task holds before it passes their counts on
_CHUNK = 200_000  # words that go through numpy at once; a longer text goes alone
END = ""  # no word is empty


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _chunks(column: pa.Array) -> Iterator[tuple[list[bytes], list[int]]]:
    """The words of some texts, the end token before the first and after each; and the tokens of each text, its end included."""
    flat, sizes = [b""], []
    for text in column:
        before = len(flat)
        flat += words_of(text.as_py())
        flat.append(b"")
        sizes.append(len(flat) - before)
        if len(flat) >= _CHUNK:
            yield flat, sizes
            flat, sizes = [b""], []
    if sizes:
        yield flat, sizes


class Store:
    """Tables of one run in the shared folder."""

    def __init__(self) -> None:
        self.paths: list[tuple] = []

    def put(self, df: DataFrame, label: str) -> DataFrame:
        path = new_shared_path(df.sparkSession, label)
        df.write.parquet(path)
        self.paths.append((df.sparkSession, path))
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        while self.paths:
            remove(*self.paths.pop())


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over the given rows, the end token included."""

    def run(it):
        schema = pa.schema([("word", pa.string()), ("c", pa.int64())])
        counts: Counter = Counter()
        for batch in it:
            for text in batch["text"]:
                counts.update(words_of(text.as_py()))
                if len(counts) >= _FLUSH:
                    yield from batches([(w.decode(), c) for w, c in counts.items()], schema, 50_000)
                    counts.clear()
            counts[b""] += batch.num_rows
        yield from batches([(w.decode(), c) for w, c in counts.items()], schema, 50_000)

    found = docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
    return found.where("c > 0")


def count_steps(docs: DataFrame, words: list[bytes]) -> np.ndarray:
    """Steps between the given words; then the rest; then the end, which also stands before every text."""
    k = len(words)
    sent = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})

    def run(it):
        number, total = sent.value.get, np.zeros((k + 2) * (k + 2), np.int64)
        for batch in it:
            for text in batch["text"]:
                ids = np.array([k + 1, *[number(w, k) for w in words_of(text.as_py())], k + 1])
                pairs, n = np.unique(ids[:-1] * (k + 2) + ids[1:], return_counts=True)
                total[pairs] += n
        schema = pa.schema([("a", pa.int32()), ("b", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])
        rows = []
        for a, row in enumerate(total.reshape(k + 2, k + 2)):
            b = np.flatnonzero(row)
            if len(b):
                rows.append((a, b, row[b]))
        yield from batches(rows, schema, 256)

    def add(key, rows):
        total = np.zeros(k + 2, np.int64)
        for b, n in zip(rows["b"], rows["n"], strict=True):
            total[np.asarray(b.values)] += np.asarray(n.values)
        at = np.flatnonzero(total)
        return pa.table({"a": pa.array([key[0].as_py()], pa.int32()), "b": pa.array([at], pa.list_(pa.int32())),
                         "n": pa.array([total[at]], pa.list_(pa.int64()))})

    found = docs.select("text").mapInArrow(run, "a int, b array<int>, n array<long>")
    out = np.zeros((k + 2, k + 2), np.int64)
    for row in found.groupBy("a").applyInArrow(add, "a int, b array<int>, n array<long>").toArrow().to_pylist():
        out[row["a"], row["b"]] = row["n"]
    return out


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(steps: np.ndarray, classes: int, sweeps: int = 8) -> np.ndarray:
    """Class of each word; ``steps`` ends with the rest and the end, which keep the last two classes to themselves."""
    k = len(steps) - 2
    of = np.concatenate([np.arange(k) % classes, [classes, classes + 1]])
    n = classes + 2
    steps = steps.astype(float)
    table = np.zeros((n, n))
    np.add.at(table, (of[:, None], of[None, :]), steps)
    out_of, into = steps.sum(1), steps.sum(0)
    every = np.arange(n)
    for _ in range(sweeps):
        moved = 0
        for w in range(k):
            after = np.bincount(of, steps[w], n)
            before = np.bincount(of, steps[:, w], n)
            self = steps[w, w]
            was = of[w]
            after[was] -= self
            before[was] -= self
            table[was] -= after
            table[:, was] -= before
            table[was, was] -= self
            rows, columns = table.sum(1), table.sum(0)
            gain_row = _f(table + after) - _f(table)
            gain_column = _f(table + before[:, None]) - _f(table)
            here = table[every, every]
            gain = (gain_row.sum(1) - gain_row[every, every] + gain_column.sum(0) - gain_column[every, every]
                    + _f(here + after + before + self) - _f(here)
                    - _f(rows + out_of[w]) + _f(rows) - _f(columns + into[w]) + _f(columns))
            best = int(np.argmax(gain[:classes]))
            if gain[best] <= gain[was] + 1e-9:
                best = was
            table[best] += after
            table[:, best] += before
            table[best, best] += self
            moved += best != was
            of[w] = best
        if moved * 200 < k:
            break
    return of


def _emit(local: dict[bytes, int], codes: list[np.ndarray], size: int) -> Iterator[pa.RecordBatch]:
    """(word, met): the keys a word met as 32-bit numbers, times * size + key."""
    names = pa.array(local, pa.binary()).cast(pa.string())
    found, n = np.unique(np.concatenate(codes), return_counts=True)
    most = 0xFFFFFFFF // size - 1
    while len(found):  # once, unless a key was met more often than a number holds
        packed = (np.minimum(n, most) * size + found % size).astype("<u4")
        words, first = np.unique(found // size, return_index=True)
        for i in range(0, len(words), 20_000):
            offsets = np.append(first, len(found))[i:i + 20_001]
            met = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(offsets) - 1,
                [None, pa.py_buffer(((offsets - offsets[0]) * 4).astype(np.int64)), pa.py_buffer(packed[offsets[0]:offsets[-1]].tobytes())])
            yield pa.RecordBatch.from_arrays([names.take(pa.array(words[i:i + 20_000])), met.cast(pa.binary())], ["word", "met"])
        found, n = found[n > most], n[n > most] - most


def count_contexts(docs: DataFrame, words: list[bytes], of: np.ndarray) -> DataFrame:
    """(word, met) of all other words: how often each class stands before (its number) or after (that plus the classes) the word.

    Several rows per word, one from each time a task passes its counts on.
    """
    n, rest = int(of.max()) + 1, int(of[-2])
    sent = docs.sparkSession.sparkContext.broadcast({**dict(zip(words, of.tolist())), b"": int(of[-1])})

    def run(it):
        number, local, codes, held = sent.value.get, {}, [], 0
        for batch in it:
            for flat, _ in _chunks(batch["text"]):
                classes = np.array([number(w, rest) for w in flat], np.int64)
                at = np.flatnonzero(classes == rest)
                ids = np.array([local.setdefault(flat[i], len(local)) for i in at.tolist()], np.int64) * (2 * n)
                codes += [ids + classes[at - 1], ids + n + classes[at + 1]]
                held += 2 * len(at)
                if held >= 4_000_000 or len(local) >= _FLUSH:
                    yield from _emit(local, codes, 2 * n)
                    local, codes, held = {}, [], 0
        if held:
            yield from _emit(local, codes, 2 * n)

    return docs.select("text").mapInArrow(run, "word string, met binary")


def classes_of(contexts: DataFrame, steps: np.ndarray, of: np.ndarray, weight: float = 1.0) -> DataFrame:
    """(word, c, class): each word's count, and the class that makes its neighbours likeliest.

    The rows of a word come one after another and are added up as they pass, however many they are.
    """
    n = int(of.max()) + 1
    table = np.zeros((n, n))
    np.add.at(table, (of[:, None], of[None, :]), steps.astype(float))
    before, after = (table.sum(1) + 1) / (table.sum() + n), (table.sum(0) + 1) / (table.sum() + n)
    before = (table + weight * before[:, None]) / (table.sum(0) + weight)  # of the class before, given that of the word
    after = (table + weight * after) / (table.sum(1, keepdims=True) + weight)
    logs = np.log(np.concatenate([before[:, :n - 2], after.T[:, :n - 2]]))  # by key and class

    def run(it):
        schema = pa.schema([("word", pa.string()), ("c", pa.int64()), ("class", pa.int32())])

        def row(word, sums, c):
            return pa.RecordBatch.from_arrays([pa.array([word], pa.string()), pa.array([c], pa.int64()), pa.array([int(sums.argmax())], pa.int32())], schema=schema)

        open_word = open_sums = None  # the word that the next rows may go on with
        open_c = 0
        for batch in it:
            for i in range(0, batch.num_rows, 2_000):
                part = batch.slice(i, 2_000)
                words, met = part["word"].cast(pa.string()), part["met"].cast(pa.binary())
                packed = np.frombuffer(b"".join(met.to_pylist()), "<u4").astype(np.int64)
                key, times = packed % (2 * n), packed // (2 * n)
                ends = np.cumsum([0, *np.asarray(pc.binary_length(met))]) // 4
                new = np.append(0, np.flatnonzero(np.asarray(pc.not_equal(words[1:], words[:-1]))) + 1).astype(np.int64)
                first = ends[new]
                sums = np.add.reduceat(logs[key] * times[:, None], first)
                c = np.add.reduceat(np.where(key >= n, times, 0), first)
                names = words.take(pa.array(new))
                if open_word is not None:
                    if names[0].as_py() == open_word:
                        sums[0] += open_sums
                        c[0] += open_c
                    else:
                        yield row(open_word, open_sums, open_c)
                open_word, open_sums, open_c = names[-1].as_py(), sums[-1].copy(), int(c[-1])
                if len(new) > 1:
                    yield pa.RecordBatch.from_arrays(
                        [names[:-1], pa.array(c[:-1].astype(np.int64)), pa.array(sums[:-1].argmax(1).astype(np.int32))], schema=schema)
        if open_word is not None:
            yield row(open_word, open_sums, open_c)

    return contexts.repartition("word").sortWithinPartitions("word").mapInArrow(run, "word string, c long, class int")


class ClassModel:
    """What reading a text needs: for each sent word its class and logs; ``-1`` stands for the class of all other words."""

    def __init__(self, top: list[tuple[bytes, int, int]], n_tokens: int, n_types: int, n_ends: int, in_class: np.ndarray) -> None:
        self.n, self.sent, self.n_tokens = len(in_class), len(top), n_tokens
        self.rest, self.end = self.n - 2, self.n - 1
        self.number = {w: i for i, (w, *_) in enumerate(top)}
        c = np.array([c for _, c, _ in top], float)
        self.of_word = np.array([*(x for *_, x in top), -1, self.end], int)  # last: words that are not sent, the end
        self.base_total = float(n_tokens + n_types + 1)
        self.emission = np.concatenate([np.log10(np.maximum(c, 1) / np.maximum(in_class[self.of_word[:-2]], 1)), [0.0, 0.0]])
        self.base = np.concatenate([np.log10((c + 1) / self.base_total), [0.0, np.log10((n_ends + 1) / self.base_total)]])

    def read(self, flat: list[bytes], sizes: list[int]) -> dict[str, pa.Array]:
        """Per text: tokens, known ones among the sent, their baseline and emissions, steps between classes and their times.

        ``words`` are the words that were not sent, ``left`` and ``right`` the classes beside them (-1: another such word);
        ``firsts`` and ``seconds`` are such words that follow each other.
        """
        rows = len(sizes)
        ids = np.array([self.number.get(w, self.sent) for w in flat], np.int64)
        ends = np.cumsum([0, *sizes])
        ids[ends] = self.sent + 1
        classes = self.of_word[ids]
        row = np.repeat(np.arange(rows), sizes)  # of each step, by the token it leads to
        a, b = classes[:-1], classes[1:]
        known = np.bincount(row, ids[1:] < self.sent, rows).astype(np.int64) + (1 if self.n_tokens else 0)
        closed = (a >= 0) & (b >= 0)
        codes, times = np.unique(row[closed] * self.n ** 2 + a[closed] * self.n + b[closed], return_counts=True)
        at = np.flatnonzero(b < 0)
        pair = np.flatnonzero((a < 0) & (b < 0))

        def lists(values, of):
            offsets = np.append(0, np.cumsum(np.bincount(of, minlength=rows)))
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

        def text(where):
            return pa.array([flat[i] for i in where.tolist()], pa.binary()).cast(pa.string())

        numbers = lambda x: pa.array(x.astype(np.int32))
        in_row = codes // self.n ** 2
        return {
            "n_tokens": pa.array(np.array(sizes, np.int64)), "known": pa.array(known),
            "base": pa.array(np.bincount(row, self.base[ids[1:]], rows)), "part": pa.array(np.bincount(row, self.emission[ids[1:]], rows)),
            "codes": lists(numbers(codes % self.n ** 2), in_row), "times": lists(numbers(times), in_row),
            "words": lists(text(at + 1), row[at]), "left": lists(numbers(a[at]), row[at]), "right": lists(numbers(classes[at + 2]), row[at]),
            "firsts": lists(text(pair), row[pair]), "seconds": lists(text(pair + 1), row[pair])}

    def steps(self, table: np.ndarray, weight: float = 8.0) -> np.ndarray:
        """Logs of all transitions from their counts; the rest has a fixed chance after every class."""
        unseen = 1 / (self.base_total + 1)
        share = table.sum(0) + 1.0
        share[self.rest] = 0
        share /= share.sum()
        out = (1 - unseen) * (table + weight * share) / (table.sum(1, keepdims=True) + weight)
        out[:, self.rest] = unseen
        return np.log10(out)


def _sum_steps(read: DataFrame, n: int) -> DataFrame:
    """(code, times) over all rows, added up in the tasks."""

    def run(it):
        total = np.zeros(n * n, np.int64)
        for batch in it:
            np.add.at(total, np.asarray(batch["codes"].flatten()), np.asarray(batch["times"].flatten()))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["code", "times"])

    return read.select("codes", "times").mapInArrow(run, "code int, times long")


def _bucket(c: Column) -> Column:
    """Counts in steps of a sixteenth of a power of two: each small count is alone, and there are at most a thousand steps."""
    return F.floor(F.log2(c.cast("double")) * 16).cast("int")


def _least(counts: DataFrame, most: int) -> tuple[int, int]:
    """The last bucket down to which at most ``most`` words are counted, and the one at which there are as many or more (0: never)."""
    within, reached, total = 1 << 20, 0, 0
    sizes = counts.groupBy(_bucket(F.col("c")).alias("bucket")).count().collect()
    for r in sorted(sizes, key=lambda r: -r["bucket"]):
        total += r["count"]
        if total <= most:
            within = r["bucket"]
        if total >= most:
            reached = r["bucket"]
            break
    return within, reached


def _open(read: DataFrame, others: DataFrame, n: int, rest: int) -> DataFrame:
    """Per word that was not sent: its row, count and class, and the codes of the steps to and from it (-1: none, or in a pair)."""
    cls, count = F.coalesce("class", F.lit(rest)), F.coalesce("c", F.lit(0)).cast("long")
    single = read.select("uid", "held", F.explode(F.arrays_zip("words", "left", "right")).alias("x"))
    single = single.select("uid", "held", F.col("x.words").alias("word"), "x.left", "x.right").join(others, "word", "left")
    single = single.select(
        "uid", "held", F.when(F.col("left") >= 0, F.col("left") * n + cls).otherwise(-1).alias("code"),
        F.when(F.col("right") >= 0, cls * n + F.col("right")).otherwise(-1).alias("then"), cls.alias("class"), count.alias("c"))
    pair = read.select("uid", "held", F.explode(F.arrays_zip("firsts", "seconds")).alias("x"))
    pair = pair.select("uid", "held", F.col("x.firsts").alias("word"), F.col("x.seconds").alias("second"))
    pair = pair.join(others.drop("c"), "word", "left").select("uid", "held", cls.alias("one"), F.col("second").alias("word"))
    pair = pair.join(others.drop("c"), "word", "left").select(
        "uid", "held", (F.col("one") * n + cls).alias("code"), F.lit(-1).alias("then"), F.lit(-1).alias("class"), F.lit(0).cast("long").alias("c"))
    return single.union(pair)


def score(docs: DataFrame, modulus: int = 7, remainder: int = 2, clustered: int = 1_024, classes: int = 48,
          sent: int = 200_000) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark, store = docs.sparkSession, Store()
    rows = texts(docs)
    held = crc_remainder(F.col("doc_id"), modulus) == remainder
    learning = rows.where(~held)
    counts = store.put(count_words(learning), "words")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                        F.coalesce(F.sum(F.when(F.col("word") == END, F.col("c"))), F.lit(0)).alias("ends")).first()
    short = F.octet_length("word") <= 64
    frequent = counts.where((F.col("word") != END) & short)
    _, least = _least(frequent, min(clustered, sent))  # few words but the wanted ones are left to sort
    core = frequent.where(_bucket(F.col("c")) >= least).orderBy(F.desc("c"), "word").limit(min(clustered, sent)).collect()
    words = [r["word"].encode() for r in core]
    steps = count_steps(learning, words)
    of = exchange(steps, min(classes, max(1, len(words))))
    others = store.put(classes_of(count_contexts(learning, words, of), steps, of), "classes")
    top = [(w, r["c"], int(x)) for w, r, x in zip(words, core, of)]
    least, _ = _least(others.where(short), sent - len(top))
    to_send = short & (_bucket(F.col("c")) >= least)
    top += [(r["word"].encode(), r["c"], r["class"]) for r in others.where(to_send).toLocalIterator()]
    in_class = np.bincount(of[:len(core)], [r["c"] for r in core], int(of.max()) + 1)
    for r in others.groupBy("class").agg(F.sum("c").alias("c")).collect():
        in_class[r["class"]] += r["c"]
    model = ClassModel(top, totals["n"], totals["v"], totals["ends"], in_class)
    n = model.n
    shared = spark.sparkContext.broadcast(model)  # bounded by ``sent``

    def run(it):
        model, uids = shared.value, RowIds()
        for batch in it:
            done = 0
            for flat, sizes in _chunks(batch["text"]):
                part = batch.slice(done, len(sizes))
                done += len(sizes)
                yield pa.RecordBatch.from_pydict({
                    "uid": pa.array(uids.take(len(sizes)), pa.int64()), "doc_id": part["doc_id"], "held": part["held"], **model.read(flat, sizes)})

    kept = Store()  # what the result reads stays
    read = kept.put(rows.withColumn("held", held).mapInArrow(run, (
        "uid long, doc_id long, held boolean, n_tokens long, known long, base double, part double, codes array<int>, times array<int>,"
        " words array<string>, left array<int>, right array<int>, firsts array<string>, seconds array<string>")), "steps")
    met = kept.put(_open(read, others.where(~to_send), n, model.rest), "open")  # only words that were not sent can match
    store.clear()
    both = met.where(~F.col("held")).select(F.explode(F.array("code", "then")).alias("code"), F.lit(1).cast("long").alias("times"))
    every = _sum_steps(read.where(~F.col("held")), n).union(both.where("code >= 0"))
    table = np.zeros(n * n)
    for r in every.groupBy("code").agg(F.sum("times").alias("times")).collect():
        table[r["code"]] = r["times"]
    sent_logs = spark.sparkContext.broadcast(np.append(model.steps(table.reshape(n, n)).ravel(), 0.0))  # last: no step
    in_classes, base_total = np.append(np.maximum(in_class, 1), 1.0), model.base_total

    def walked(it):
        logs = sent_logs.value
        for batch in it:
            lengths = np.asarray(batch["codes"].value_lengths())
            each = logs[np.asarray(batch["codes"].flatten())] * np.asarray(batch["times"].flatten())
            step = np.bincount(np.repeat(np.arange(len(lengths)), lengths), each, len(lengths))
            columns = {c: batch[c] for c in ("uid", "doc_id", "held", "n_tokens", "known", "base")}
            yield pa.RecordBatch.from_pydict({**columns, "part": pa.array(np.asarray(batch["part"]) + step)})

    def unsent(it):
        logs = sent_logs.value
        for batch in it:
            code, then, cls, c = (np.asarray(batch[x]) for x in ("code", "then", "class", "c"))
            emission = np.where(c > 0, np.log10(np.maximum(c, 1) / in_classes[cls]), 0.0)
            base = np.where(cls >= 0, np.log10((c + 1) / base_total), 0.0)  # a pair's words are counted where they stand alone
            yield pa.RecordBatch.from_pydict({
                "uid": batch["uid"], "known": pa.array((c > 0).astype(np.int64)), "base": pa.array(base), "part": pa.array(logs[code] + logs[then] + emission)})

    joined = read.select("uid", "doc_id", "held", "n_tokens", "known", "base", "part", "codes", "times").mapInArrow(
        walked, "uid long, doc_id long, held boolean, n_tokens long, known long, base double, part double")
    found = met.select("uid", "code", "then", "class", "c").mapInArrow(unsent, "uid long, known long, base double, part double")
    found = found.groupBy("uid").agg(F.sum("known").alias("more_known"), F.sum("base").alias("more_base"), F.sum("part").alias("more_part"))
    return joined.join(found, "uid", "left").select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(totals["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("part") + F.coalesce("more_part", F.lit(0.0))).alias("score"))
