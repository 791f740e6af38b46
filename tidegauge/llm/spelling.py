"""Spelling variants of a corpus' words: near words, each word's more frequent form, and the last of its forms.

Two words are near if one inserted, deleted or replaced letter tells them apart. They are found by a bit-sliced position
index: for each place and letter, one bit for every word of the vocabulary that has the letter there. A query word is
read letter by letter against 64 words at a time: Z holds the words that agree so far, S those that agree but for one
replaced letter, I those that have had one letter more, which are then read one place further on.

        S = S & here | Z & ~here       I = (I | Z) & next       Z = Z & here

A query need not meet the whole vocabulary. The places of a word are cut into ranges of WIDTH; two near words agree in all
letters outside the range of their difference, so each word is filed, once for each range, under the hash of the others
(as a word of its own length, and as one that has a letter more). Words of one file stand together in the index, and
queries read only the 64-word slices that their file touches. All letters are compared, so hashes that meet by chance
change nothing, and a pair is counted in the one range that its first difference lies in. A file can hold
a ** WIDTH words of a length over an alphabet of a letters, and a ** (WIDTH + 1) of the next, whatever the corpus; it is read
slice by slice, and pairs are summed for each word before they leave the task.

Cases: null text has no words; repeated rows count as often as they stand; of near words with equal counts the first in
code-point order is the form; a word without near words has n_near 0; texts of any length are read whole and counted in
a table of bounded size; an empty table gives an empty result; only doc_id and text are read, whatever else there is.
A null doc_id is written as nothing.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import documents, forget, rows_of, stored

LETTERS, SLIPS = "[A-Za-zÀ-ÿ]+", 97
SHORTEST, RAREST, WIDTH = 5, 3, 3
HELD, CHUNK, UNITS = 200_000, 16_384, 1 << 16
ONES = ~np.uint64(0)


def runs(text: str, pattern: re.Pattern) -> list[str]:
    """Letter runs with A-Z lower-cased."""
    return pattern.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def slipped(run: str, seed: int) -> str:
    """The run without one letter if its hash says so; seed: crc32 of what stands before it."""
    h = zlib.crc32(run.encode(), seed)
    at = h % len(run)
    return run if h % SLIPS else run[:at] + run[at + 1 :]


def counted(docs: DataFrame, slips: bool = True) -> DataFrame:
    """docs (doc_id, text) -> (word, n): lower-cased letter runs, some of them with a letter missing, and how often they occur."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, held = re.compile(LETTERS), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for doc, text in rows_of(stream):
            seed = zlib.crc32(f"{doc or ''}:".encode())
            for run, n in Counter(runs(text, pattern)).items():
                held[slipped(run, seed) if slips else run] += n
            if len(held) > HELD:
                yield out()
                held.clear()
        yield out()

    rows = docs.where("text is not null").select(F.col("doc_id").cast("string"), "text")
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def filed(words: DataFrame, width: int = WIDTH) -> DataFrame:
    """words (word, n) -> a row (size, part, file, longer, word, n) for each file of each word: file is the hash of the letters outside
    range `part` of a word of `size` letters; `longer`: the word has one letter more than that, in the range."""

    def files(longer: int):
        size = F.length("word") - longer

        def file(part):
            start, end = part * width, F.least(size, part * width + width)
            key = F.xxhash64(size, part, F.substring(F.col("word"), F.lit(1), start), F.substring(F.col("word"), end + 1 + longer, size))
            return F.struct(size.alias("size"), part.alias("part"), key.alias("file"), F.lit(bool(longer)).alias("longer"))

        parts = F.sequence(F.lit(0), F.ceil(size / width).cast("int") - 1)
        return F.when(size > 0, F.transform(parts, file)).otherwise(F.array())

    at = F.explode(F.concat(files(0), files(1))).alias("at")
    return words.select(at, "word", "n").select("at.*", "word", "n")


class Index:
    """The bit-sliced position index of words that stand file by file: `size` letters, or one more where `longer` says so."""

    def __init__(self, words: list[str], longer: np.ndarray, size: int):
        self.size, n = size, len(words)
        points = np.frombuffer("".join(w.ljust(size + 1, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(n, size + 1)
        alphabet = np.unique(points)
        self.letters = np.searchsorted(alphabet, points)
        self.slices, self.kinds = -(-n // 64), len(alphabet)
        row = np.arange(n)
        bit = np.uint64(1) << (row % 64).astype(np.uint64)
        self.bits = np.zeros((size + 1, self.slices * self.kinds), np.uint64)
        for place in range(size + 1):
            np.bitwise_or.at(self.bits[place], row // 64 * self.kinds + self.letters[:, place], bit)
        self.longer = np.zeros(self.slices, np.uint64)
        np.bitwise_or.at(self.longer, row[longer] // 64, bit[longer])

    def meet(self, query: np.ndarray, slice_: np.ndarray, file: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(replaced, inserted): for each query (a row of the index) and slice, the words of its file (bits) that differ from it by one
        replaced letter, or have one more, where the first difference lies in places start to end."""
        z, s, i = np.full(len(query), ONES), np.zeros(len(query), np.uint64), np.zeros(len(query), np.uint64)
        outside_s, outside_i = np.zeros(len(query), np.uint64), np.zeros(len(query), np.uint64)
        for place in range(self.size):
            at = slice_ * self.kinds + self.letters[query, place]
            here, further = self.bits[place][at], self.bits[place + 1][at]
            s = (s & here) | (z & ~here)
            i = (i | z) & further
            z = z & here
            # Agreeing words so far: the first difference lies after this place.
            if place == start - 1:
                outside_s |= ~z
            if place == start and start:
                outside_i |= ~z
            if place == end - 1:
                outside_s |= z
            if place == end:
                outside_i |= z
        longer = self.longer[slice_]
        return s & ~longer & file & ~outside_s, (i | z) & longer & file & ~outside_i


def pairs(words: list[str], longer: np.ndarray, ends: np.ndarray, size: int, start: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (word, near word) of words that stand file by file (`ends`: where the files end), each pair in both directions."""
    index = Index(words, longer, size)
    first = np.r_[0, ends[:-1]]
    of = np.repeat(np.arange(len(ends)), ends - first)  # each row's file
    query = np.flatnonzero(~longer)
    low, high = first[of[query]], ends[of[query]]
    many = (high - 1) // 64 - low // 64 + 1  # slices that a query's file touches
    total = np.cumsum(many)
    for begin in range(0, int(total[-1]) if len(total) else 0, UNITS):
        unit = np.arange(begin, min(begin + UNITS, int(total[-1])))
        k = np.searchsorted(total, unit, "right")
        slice_ = low[k] // 64 + unit - (total[k] - many[k])
        lo, hi = np.maximum(low[k], slice_ * 64) - slice_ * 64, np.minimum(high[k], slice_ * 64 + 64) - slice_ * 64
        file = (ONES << lo.astype(np.uint64)) & (ONES >> (64 - hi).astype(np.uint64))
        for kind, found in enumerate(index.meet(query[k], slice_, file, start, end)):
            some = np.flatnonzero(found)
            if len(some):
                which, bit = np.nonzero(np.unpackbits(found[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                one, other = query[k[some[which]]], slice_[some[which]] * 64 + bit
                yield one, other
                if kind:
                    yield other, one


def near_of(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of filed(), sorted by size, part and file, to (word, n_near, best_n, best): near words found in some of the files, counted, with
    the most frequent of them."""

    def met(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        size, part = rows["size"][0].as_py(), rows["part"][0].as_py()
        file = rows["file"].to_numpy()
        last = np.r_[file[1:] != file[:-1], True]
        alone = last & np.r_[True, last[:-1]]
        rows, last = rows.filter(pa.array(~alone)), last[~alone]
        if not rows.num_rows:
            return
        words, n, longer = rows["word"].to_pylist(), rows["n"].to_numpy(), rows["longer"].to_numpy().astype(bool)
        for_all = list(pairs(words, longer, np.flatnonzero(last) + 1, size, part * WIDTH, min(size, part * WIDTH + WIDTH)))
        if not for_all:
            return
        one, other = (np.concatenate(c) for c in zip(*for_all, strict=True))
        _, place = np.unique(np.array(words)[other], return_inverse=True)
        order = np.lexsort((place, -n[other], one))
        one, other = one[order], other[order]
        top = np.flatnonzero(np.r_[True, one[1:] != one[:-1]])
        own, best, count = one[top], other[top], np.diff(np.r_[top, len(one)])
        named = lambda at: pa.array([words[k] for k in at], pa.string())
        yield pa.RecordBatch.from_arrays([named(own), pa.array(count), pa.array(n[best]), named(best)], ["word", "n_near", "best_n", "best"])

    held: pa.Table | None = None
    for b in stream:
        if not b.num_rows:
            continue
        now = pa.Table.from_batches([b])
        held = now if held is None else pa.concat_tables([held, now])
        if held.num_rows < CHUNK:
            continue
        size, part, file = (held[c].to_numpy() for c in ("size", "part", "file"))
        new_part = np.flatnonzero((size[1:] != size[:-1]) | (part[1:] != part[:-1])) + 1
        new_file = np.flatnonzero(file[1:] != file[:-1]) + 1
        cut = max(new_part[-1:].tolist() + new_file[-1:].tolist(), default=0)  # the last file may go on
        begins = [0, *new_part[new_part < cut].tolist(), cut]
        for a, z in zip(begins, begins[1:], strict=False):
            if z > a:
                yield from met(held.slice(a, z - a))
        held = held.slice(cut)
    if held is not None:
        size, part = (held[c].to_numpy() for c in ("size", "part"))
        begins = [0, *(np.flatnonzero((size[1:] != size[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), held.num_rows]
        for a, z in zip(begins, begins[1:], strict=False):
            yield from met(held.slice(a, z - a))


def near_words(words: DataFrame) -> DataFrame:
    """words (word, n; each word once) -> (word, n_near, best_n, best) of the words that have near words."""
    rows = filed(words).repartition("file").sortWithinPartitions("size", "part", "file")
    found = rows.mapInArrow(near_of, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """forms (word, form) -> (word, root): forms followed to the last. Each step doubles the way gone; forms grow in count, so there
    are no circles, and the steps are few."""
    now = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while not now.where("moved").isEmpty():
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = stored(step, "forms")
        forget(now)
        now = step
    return now.select("word", "root")


def variants(words: DataFrame) -> DataFrame:
    """words (word, n) -> word, form, root, n, n_near, form_n."""
    words = stored(words, "vocabulary")
    found = words.join(near_words(words), "word", "left")
    form = lambda c: F.when(F.col("best_n") >= 2 * F.col("n"), F.col(c))
    found = stored(found.select("word", form("best").alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form("best_n").alias("form_n")), "near-words")
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = counted(documents(spark, sf_dir))
    return variants(words.where((F.length("word") >= SHORTEST) & (F.col("n") >= RAREST)))


def oracle_sql() -> str:
    """The same in DuckDB SQL: crc32 by its table, made from the polynomial, and near words by deleted letters."""
    return """
    WITH RECURSIVE bits AS (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS t(i)),
    crc AS (SELECT list(v ORDER BY i) AS t FROM bits),
    runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents WHERE text IS NOT NULL),
    low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL),
    bytes AS (SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END)) AS b FROM low),
    hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h FROM bytes, crc),
    slipped AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words),
    less AS (SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM places),
    pairs AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
    UNION SELECT w.word, w.n, l.word, l.n FROM words w JOIN less l ON l.rest = w.word UNION SELECT l.word, l.n, w.word, w.n FROM words w JOIN less l ON l.rest = w.word),
    best AS (SELECT word, n, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word, n),
    forms AS (SELECT word, near AS form, near_n AS form_n FROM best WHERE near_n >= 2 * n),
    walk AS (SELECT word, form AS root FROM forms UNION ALL SELECT w.word, f.form FROM walk w JOIN forms f ON w.root = f.word),
    ends AS (SELECT word, root FROM walk WHERE root NOT IN (SELECT word FROM forms))
    SELECT w.word, f.form, coalesce(e.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n FROM words w LEFT JOIN best b ON w.word = b.word LEFT JOIN forms f ON w.word = f.word LEFT JOIN ends e ON w.word = e.word
    """
