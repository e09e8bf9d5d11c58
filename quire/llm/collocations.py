"""Phrase collocation mining: frequent phrases get their names from pairs of shorter ones, level by level."""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import bucketed, discard, partitions, settle, stored

#: A phrase that occurs so often is a candidate; one of which so many per cent stand in one longer candidate is dropped.
LEAST, COVERED = 10, 50
#: Words of the longest phrase, and rows of a language's report.
LONGEST, REPORT = 3, 2000
#: Words of all languages after which the largest languages' blocks of documents end; there may be one document more.
BLOCK_WORDS = 1 << 21
#: Words of the corpus for each group in which the blocks' words or pairs are counted.
GROUP_WORDS = 1 << 21

# The characters that end a piece become line ends, tabs become spaces, A-Z lower case.
_FOLD = bytes(10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_TOKEN = re.compile(rb"[^ \n]+|\n")

_BLOCK = "block long, lang string, n long, tokens binary, words binary, counts binary"
_LEVEL = "block long, lang string, tokens binary, sent array<binary>"
_SENT = "dest int, block long, lang string, sent binary, words binary"
_ANSWER = "block long, dest int, names binary, name array<long>, f array<long>"
_WORDS, _PAIRS = f"{_ANSWER}, lang array<string>, word array<binary>", f"{_ANSWER}, a array<long>, b array<long>"


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of as many whole numbers from 0 on, in few bytes: the bytes of equal weight stand together and are compressed."""
    widths = [max(1, -(-int(c.max(initial=0)).bit_length() // 8)) for c in columns]
    planes = b"".join(c.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for c, w in zip(columns, widths, strict=True))
    return struct.pack(f"<I{len(widths)}B", len(columns[0]), *widths) + pa.compress(planes, "zstd", asbytes=True)


def _unpack(data: bytes, columns: int = 1) -> list[np.ndarray]:
    n, *widths = struct.unpack_from(f"<I{columns}B", data)
    planes = np.frombuffer(pa.decompress(data[4 + columns :], n * sum(widths), "zstd", asbytes=True), np.uint8)
    out = []
    for w, end in zip(widths, np.cumsum(widths) * n, strict=True):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :w] = planes[end - w * n : end].reshape(w, n).T
        out.append(wide.view("<i8").reshape(n))
    return out


def pieces(text: str | None) -> list[bytes]:
    """A text's words, with a line end after each piece."""
    return _TOKEN.findall((text or "").encode("utf-8", "surrogatepass").translate(_FOLD)) + [b"\n"]


def _encode(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to one row for each block and language: local numbers of words plus 1, 0 between pieces, and what they mean.

    Words are numbered in the order of their hashes, so those of any group stand together.
    """
    task, seq, total, held = TaskContext.get().partitionId(), count(), 0, defaultdict(int)
    numbers: dict[str, defaultdict[bytes, int]] = {}
    streams: defaultdict[str, list[np.ndarray]] = defaultdict(list)

    def flush(lang: str) -> pa.RecordBatch:
        known, tokens = numbers.pop(lang), np.concatenate(streams.pop(lang))
        del known[b"\n"], held[lang]
        words = list(known)
        order = np.argsort(_hashes(words), kind="stable")
        place = np.zeros(len(words) + 1, np.int64)  # the last one is that of -1
        place[order] = np.arange(1, len(words) + 1)
        tokens = place[tokens]
        at = np.bincount(tokens, minlength=len(words) + 1)[1:]
        return pa.RecordBatch.from_arrays([
            pa.array([task << 32 | next(seq)]), pa.array([lang]), pa.array([int(at.sum())], pa.int64()), pa.array([_pack(tokens)]), pa.array([b"\n".join([words[i] for i in order])]), pa.array([_pack(at)]),
        ], names=["block", "lang", "n", "tokens", "words", "counts"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if lang not in numbers:
                numbers[lang] = defaultdict(count().__next__, {b"\n": -1})
            words = pieces(text)
            streams[lang].append(np.fromiter(map(numbers[lang].__getitem__, words), np.int32, len(words)))
            held[lang] += len(words)
            total += len(words)
            for largest in sorted(held, key=held.__getitem__, reverse=True) if total >= block_words else ():
                if 2 * total > block_words:
                    total -= held[largest]
                    yield flush(largest)
    for lang in list(numbers):
        yield flush(lang)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint64, len(words))


def _group(hashes: np.ndarray, groups: int) -> np.ndarray:
    """The group, from 0 to groups - 1, of a 32-bit hash; it does not fall from a hash to the next one."""
    return ((hashes * np.uint64(groups)) >> np.uint64(32)).astype(np.int64)


def _group_of_pair(a: np.ndarray, b: np.ndarray, groups: int) -> np.ndarray:
    h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return _group(h >> np.uint64(32), groups)


def _send(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Blocks' vocabularies to one row for each group that has words of theirs."""
    for batch in batches:
        for block, lang, blob, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words, times = blob.split(), _unpack(counts)[0]
            ends = np.searchsorted(_group(_hashes(words), groups), np.arange(groups + 1))
            parts = [(d, i, j) for d, (i, j) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if i < j]
            yield pa.RecordBatch.from_arrays([
                pa.array([d for d, _, _ in parts], pa.int32()), pa.array([block] * len(parts), pa.int64()), pa.array([lang] * len(parts), pa.string()), pa.array([_pack(times[i:j]) for _, i, j in parts], pa.binary()),
                pa.array([_squeeze(b"\n".join(words[i:j])) for _, i, j in parts], pa.binary()),
            ], names=["dest", "block", "lang", "sent", "words"])


def _squeeze(data: bytes) -> bytes:
    return struct.pack("<I", len(data)) + pa.compress(data, "zstd", asbytes=True)


def _unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[4:], struct.unpack_from("<I", data)[0], "zstd", asbytes=True)


def _pair_up(level: pa.Table, answers: pa.Table, groups: int) -> pa.Table:
    """A block's stream of local numbers, and the names that the groups gave them, to its stream of pairs of neighbours that both have
    a name; and for each group its pairs in the order of their numbers: their two names (the first ones as differences) and counts in the block.
    """
    if not level.num_rows:
        return pa.table({"block": level["block"], "lang": level["lang"], "tokens": level["tokens"], "sent": pa.array([], pa.list_(pa.binary()))})
    tokens = _unpack(level["tokens"][0].as_py())[0]
    name = np.concatenate([[0], *(_unpack(x)[0] for x in answers.sort_by("dest")["names"].to_pylist())]).astype(np.int64)
    known, code = np.unique(name, return_inverse=True)  # 0, for no name, comes first
    code = code[tokens]
    both = (code[:-1] > 0) & (code[1:] > 0)
    pair, at, times = np.unique(code[:-1][both] * len(known) + code[1:][both], return_inverse=True, return_counts=True)
    a, b = known[pair // len(known)], known[pair % len(known)]
    dest = _group_of_pair(a, b, groups)
    order = np.argsort(dest, kind="stable")
    place = np.empty(len(pair), np.int64)
    place[order] = np.arange(1, len(pair) + 1)
    out = np.zeros(len(both), np.int64)
    out[both] = place[at]
    out = out[(out > 0) | np.r_[False, out[:-1] > 0]]  # one 0 for a run of them
    a, b, times, ends = a[order], b[order], times[order], np.searchsorted(dest[order], np.arange(groups + 1))
    sent = [_pack(np.diff(a[i:j], prepend=0), b[i:j], times[i:j]) if i < j else None for i, j in zip(ends[:-1], ends[1:], strict=True)]
    return pa.table({"block": level["block"], "lang": level["lang"], "tokens": pa.array([_pack(out)]), "sent": pa.array([sent], pa.list_(pa.binary()))})


def _one_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers from 0 on, however large."""
    if (int(a.max()) + 1) * (int(b.max()) + 1) >= 1 << 63:
        a, b = (np.unique(x, return_inverse=True)[1] for x in (a, b))
    return a * (int(b.max()) + 1) + b


def _answers(messages: pa.Table, groups: int, least: int, keys: np.ndarray, times: list[np.ndarray], meaning: Callable[[np.ndarray], dict[str, pa.Array]], answer: bool = True) -> pa.Table:
    """Of a group's messages, with a number for each key in them: one row of the keys that occur `least` times or more, their names and counts;
    and for each message a row with the names of its keys in order, 0 for those that are rare.

    The more often a key occurs, the lower is its name. meaning: the columns that tell what the keys at these places are.
    """
    dest = messages["dest"][0].as_py()
    _, first, at = np.unique(keys, return_index=True, return_inverse=True)
    f = np.zeros(len(first), np.int64)
    np.add.at(f, at, np.concatenate(times))
    kept = np.flatnonzero(f >= least)
    kept = kept[np.argsort(-f[kept], kind="stable")]
    name = np.zeros(len(first), np.int64)
    name[kept] = np.arange(len(kept)) * groups + dest + 1  # no other group has these, and all are about as high
    found = {"name": pa.array(name[kept]), "f": pa.array(f[kept])} | meaning(first[kept])
    told = [_pack(x) for x in np.split(name[at], np.cumsum([len(t) for t in times])[:-1])] if answer else []
    made = {"block": pa.array([None, *messages["block"].to_pylist()[: len(told)]], pa.int64()), "dest": pa.array([dest] * (len(told) + 1), pa.int32()), "names": pa.array([None, *told], pa.binary())}
    return pa.table(made | {k: pa.ListArray.from_arrays(pa.array([0] + [len(v)] * (len(told) + 1), pa.int32()), v) for k, v in found.items()})


def _count_words(messages: pa.Table, groups: int, least: int) -> pa.Table:
    times = [_unpack(x)[0] for x in messages["sent"].to_pylist()]
    words = pa.array([w for x in messages["words"].to_pylist() for w in _unsqueeze(x).split()], pa.binary())
    langs = messages["lang"].combine_chunks().dictionary_encode()
    lang, word = np.repeat(langs.indices.to_numpy(), [len(t) for t in times]).astype(np.int64), words.dictionary_encode().indices.to_numpy().astype(np.int64)
    return _answers(messages, groups, least, _one_key(lang, word), times, lambda at: {"lang": langs.dictionary.take(pa.array(lang[at])), "word": words.take(pa.array(at))})


def _count_pairs(messages: pa.Table, groups: int, least: int, answer: bool) -> pa.Table:
    a, b, times = zip(*(_unpack(x, 3) for x in messages["sent"].to_pylist()), strict=True)
    a, b = np.concatenate([np.cumsum(x) for x in a]), np.concatenate(b)
    return _answers(messages, groups, least, _one_key(a, b), list(times), lambda at: {"a": pa.array(a[at]), "b": pa.array(b[at])}, answer)


def _exact(c: Column) -> Column:
    return c.cast("decimal(16,0)")


def _scored(k: int) -> Column:
    """The cut of a phrase of k words with the least floor(1000000 a a / (l r)), the first of those, as (score, k, l, r)."""
    cut = lambda j: (F.col("pre")[j - 1], F.col("suf")[k - j - 1])
    whole = lambda a, lr: F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (_exact(a) * _exact(a)), _exact(lr[0]) * _exact(lr[1]))
    cuts = [F.struct(whole(F.col("f"), cut(j)).alias("score"), F.lit(j).alias("k"), cut(j)[0].alias("l"), cut(j)[1].alias("r")) for j in range(1, k)]
    return F.array_min(F.array(*cuts))


def _met(sent: DataFrame, groups: int, count: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return sent.repartition(groups, "dest").groupBy("dest").applyInArrow(lambda t: count(t), schema)


def _frequent(told: DataFrame, *key: str) -> DataFrame:
    rows = told.where("block IS NULL").select(F.explode(F.arrays_zip("name", "f", *key)).alias("at"))
    return rows.select("at.name", *(f"at.{k}" for k in key), "at.f")


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Collocations (lang, phrase, a, l, r, score) of all languages, and every language's number of words (lang, n).

    Words are runs of other characters than space and tab, within pieces between `.,;:!?` and line ends, A-Z lower-cased. Phrases of 2 to
    `longest` words that occur `least` times are candidates. score = floor(1000000 a a / (l r)) of the worst cut into a first
    part that occurs l times and a rest that occurs r times. A candidate is dropped if `covered` per cent of its occurrences or
    more are as many as those of one longer candidate around it. All counts are exact, over whole texts and all documents.

    Each block of documents numbers its own words and sends them, packed, to groups by hash; a group counts its words over all blocks and
    sends the names of the frequent ones back, in the order in which it got them. Blocks pair neighbours that both have a
    name; pairs of frequent (k-1)-grams that overlap are the k-grams that may be frequent, and get names in the same way. A gram's
    row holds the names of its two parents, so cuts and longer candidates are looked up by joins on names. Occurrences never
    leave their block. A key has at most one place in a message of a block, however often it occurs.

    The blocks are in buckets by their own number, so that their words are not shuffled when names come back to them.

    Null texts are empty; a null language is `und`. Texts without words, repeated rows, very long texts and an empty table are nothing special; a
    table without words has no languages. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), rows.rdd.getNumPartitions() // 4)
    level = bucketed(rows.mapInArrow(lambda it: _encode(it, block_words), _BLOCK), "block", buckets)
    words = settle(level.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"))
    groups = partitions(spark, words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], GROUP_WORDS)
    sent = level.select("block", "lang", "words", "counts").mapInArrow(lambda it: _send(it, groups), _SENT)
    told = stored(_met(sent, groups, lambda t: _count_words(t, groups, least), _WORDS))
    one = F.array("f")
    found = _frequent(told, "lang", "word").withColumn("word", F.col("word").cast("string"))
    grams = settle(found.select("name", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", one.alias("pre"), one.alias("suf")))
    found = []
    for k in range(2, longest + 1):
        answers = told.where("block IS NOT NULL").select("block", "dest", "names")
        paired = level.select("block", "lang", "tokens").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda of, to: _pair_up(of, to, groups), _LEVEL)
        before, level = (level, told), bucketed(paired, "block", buckets) if k < longest else paired
        sent = level.select("block", F.posexplode("sent").alias("dest", "sent")).where("sent IS NOT NULL").select("dest", "block", "sent")
        if k < longest:
            discard(*before)
            told = stored(_met(sent, groups, lambda t: _count_pairs(t, groups, least, True), _PAIRS))
            pairs = settle(_frequent(told, "a", "b"))
        else:
            pairs = settle(_frequent(_met(sent, groups, lambda t: _count_pairs(t, groups, least, False), _PAIRS), "a", "b"))
            discard(*before)
        longer = pairs.select(F.col("a").alias("name"), "f").union(pairs.select("b", "f")).groupBy("name").agg(F.max("f").alias("most"))
        if k > 2:
            found[-1] = found[-1].join(longer, "name", "left").where(f"most IS NULL OR 100 * most < {covered} * f").drop("most")
        first = grams.select(F.col("name").alias("a"), "lang", F.col("phrase").alias("head"), F.col("pre").alias("before"))
        second = grams.select(F.col("name").alias("b"), "last", F.col("suf").alias("behind"))
        made = pairs.join(first, "a").join(second, "b")
        grams = settle(made.select("name", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f", F.concat("before", one).alias("pre"), F.concat("behind", one).alias("suf")))
        found.append(grams.select("name", "lang", "phrase", "f", _scored(k).alias("cut")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"), words


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", report: int = REPORT, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `report` phrases by score, a (both descending) and phrase.

    Where `report` is 1,000 or less, Spark takes each partition's first rows before it brings a language's together; else one task ranks
    all of a language's candidates. Odd rows as in phrases().
    """
    found, words = phrases(docs, text_col, lang_col, longest, least, covered)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= report)
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rows in DuckDB.
ORACLE = """
WITH pieces AS (
    SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(t) AS piece, generate_subscripts(t, 1) AS part
    FROM (SELECT doc_id, lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]') AS t FROM documents)),
words AS (
    SELECT doc_id, lang, part, unnest(w) AS word, generate_subscripts(w, 1) AS place
    FROM (SELECT doc_id, lang, part, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces)),
runs AS (
    SELECT lang, word AS w1, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3
    FROM words WINDOW o AS (PARTITION BY doc_id, part ORDER BY place)),
total AS (SELECT lang, count(*) AS n FROM runs GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
around AS (
    SELECT lang, w1, w2, max(f) AS most
    FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
two AS (
    SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r,
        (1000000::HUGEINT * f2.f::HUGEINT * f2.f::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
    FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
    LEFT JOIN around m ON m.lang = f2.lang AND m.w1 = f2.w1 AND m.w2 = f2.w2
    WHERE f2.f >= 10 AND (m.most IS NULL OR 100 * m.most < 50 * f2.f)),
three AS (
    SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.f AS a, p.f AS l1, q.f AS r1, s.f AS l2, t.f AS r2,
        (1000000::HUGEINT * f3.f::HUGEINT * f3.f::HUGEINT) // (p.f::HUGEINT * q.f::HUGEINT) AS s1,
        (1000000::HUGEINT * f3.f::HUGEINT * f3.f::HUGEINT) // (s.f::HUGEINT * t.f::HUGEINT) AS s2
    FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.w1 = f3.w1 JOIN f2 q ON q.lang = f3.lang AND q.w1 = f3.w2 AND q.w2 = f3.w3
    JOIN f2 s ON s.lang = f3.lang AND s.w1 = f3.w1 AND s.w2 = f3.w2 JOIN f1 t ON t.lang = f3.lang AND t.w1 = f3.w3),
found AS (
    SELECT lang, phrase, a, l, r, score FROM two
    UNION ALL
    SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM three),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM found)
SELECT ranked.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
