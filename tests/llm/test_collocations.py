import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from landroll.llm import collocations, queries

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute_top(rows, limit, least):
    """rows: (doc_id, text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in candidates.items()):
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), a, l, r, score))
        for rank, (_, _, phrase, a, l, r, score) in enumerate(sorted(kept)[:limit], 1):
            out.append((lang, rank, phrase.decode(), a, l, r, n[lang], score))
    return sorted(out)


def texts(seed, docs=60, words=400):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "c", "d", "E", "é", "ß", "漢字", "x y", "New", "York", "city", "of"]
    fixed = ["New York city of", "a b c d", "É é", "of the", "d d d d d"]
    out = []
    for i in range(docs):
        parts = [rnd.choice(fixed) if rnd.random() < 0.2 else rnd.choice(vocabulary) for _ in range(words)]
        text = "".join(p + rnd.choice([" ", " ", "  ", "\t", ", ", ". ", "\n", "! "]) for p in parts)
        out.append((i, text, rnd.choice(["en", "en", "fr", None, "und", "a\nb"])))
    return out + [(100, None, "en"), (101, "", "fr"), (102, " .,\t", "de"), (103, "only", "es"), (None, "a b c d " * 50, "en")]


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("first, limit, least", [(4, 2000, 30), (1, 1, 5), (1, 7, 5), (2, 25, 2)])
def test_equals_brute_force(spark, monkeypatch, first, limit, least):
    monkeypatch.setattr(collocations, "FIRST", first)
    monkeypatch.setattr(collocations, "MIN_COUNT", least)
    rows = texts(limit, docs=60 if least > 2 else 25)
    got = found(collocations.top_phrases(brute.documents(spark, rows), limit))
    assert got == brute_top(rows, limit, least)


def test_only_hopeful_prefixes_are_grown(spark, monkeypatch):
    """A few certain phrases beside many chance pairs: longer phrases are counted for the certain ones alone."""
    monkeypatch.setattr(collocations, "FIRST", 1)
    rnd = random.Random(5)
    rows = [(i, " ".join(["in vitro fertilisation"] + [rnd.choice("abcdefgh") for _ in range(300)]) + ".", "en")
            for i in range(80)]
    counted = {}
    count = collocations.count_phrases

    def counting(docs, *wants):
        out = count(docs, *wants)
        for row in out.where("phrase <> ''").selectExpr("size(split(phrase, ' ')) as order").groupBy("order").count().collect():
            counted[row.order] = counted.get(row.order, 0) + row["count"]
        return out

    monkeypatch.setattr(collocations, "count_phrases", counting)
    got = found(collocations.top_phrases(brute.documents(spark, rows), 1))
    assert got == brute_top(rows, 1, 30)
    frequent = Counter()
    for _, t, _ in rows:
        w = t.rstrip(".").split()
        frequent.update(zip(w, w[1:], w[2:]))
    assert counted[3] < 0.2 * sum(c >= 30 for c in frequent.values())


class Shared:
    def __init__(self, lang, phrases):
        table = collocations.Bits()
        columns = [collocations._word_hashes(lang, list(c)) for c in zip(*[p.split(b" ") for p in phrases])]
        hashes = columns[0]
        for c in columns[1:]:
            hashes = collocations._mix(hashes, c)
        table.add(hashes)
        self.value = table.words


def counted(words, want):
    return {p: int(n) for phrases, counts in words.counts(want) for p, n in zip(phrases, counts)}


def test_counts_of_a_chunk():
    words = collocations._Words("en", [b"a b. c", b"", b"d a b\ta", "a B É".encode()])
    assert counted(words, collocations.Want(1)) == {b"a": 4, b"b": 3, b"c": 1, b"d": 1, "É".encode(): 1, b"": 10}
    known = Shared("en", [b"a", b"b", b"c", b"d"])
    assert counted(words, collocations.Want(2, known)) == {b"a b": 3, b"d a": 1, b"b a": 1}
    pairs = Shared("en", [b"a b", b"d a", b"b a"])
    first, last = Shared("en", [b"d a"]), Shared("en", [b"b a"])
    assert counted(words, collocations.Want(3, pairs, first, last)) == {b"d a b": 1, b"a b a": 1}
    assert counted(words, collocations.Want(3, pairs, first)) == {b"d a b": 1}
    assert counted(words, collocations.Want(4, pairs, Shared("en", [b"d a b"]), last)) == {b"d a b a": 1}
    nothing = collocations._Words("en", [b" .", b""])
    assert counted(nothing, collocations.Want(1)) == {b"": 0} and counted(nothing, collocations.Want(4, pairs, first)) == {}


def test_chunks_do_not_change_counts(spark, monkeypatch):
    rows = texts(9, docs=20)
    docs = brute.documents(spark, rows).coalesce(1)
    whole = sorted(map(tuple, collocations.count_phrases(docs, collocations.Want(1)).collect()))
    monkeypatch.setattr(collocations, "CHUNK", 100)
    assert sorted(map(tuple, collocations.count_phrases(docs, collocations.Want(1)).collect())) == whole


def test_bit_table_never_misses(spark):
    rows = [("en", f"w{i} v{i % 97}") for i in range(5000)] + [("fr", "w1 v1")]
    table = collocations._bits(spark.createDataFrame(rows, "lang string, phrase string").repartition(9)).value
    bits = collocations.Bits(table)
    left, right = (collocations._word_hashes("en", [p.split()[k].encode() for _, p in rows[:-1]]) for k in (0, 1))
    assert bits.has(collocations._mix(left, right)).all()
    other = collocations._mix(left, collocations._word_hashes("en", [b"none"] * len(left)))
    assert bits.has(other).mean() < 0.01
    assert not collocations.Bits().has(np.arange(10, dtype=np.uint64)).any()


def test_scores_beyond_64_bits(spark):
    rows = spark.createDataFrame([(2 ** 60, 2 ** 61, 2 ** 60 + 7)], "a long, l long, r long")
    got = rows.select(collocations._ratio(F.col("a"), F.col("l"), F.col("r")).alias("s")).first().s
    assert got == 2000000 * 2 ** 60 // (2 ** 61 + 2 ** 60 + 7)


def test_query_with_clashing_columns_and_empty_table(spark, tmp_path):
    rows = texts(3)
    docs = brute.documents(spark, rows, extra=True)
    for name in ("phrase", "a", "l", "r", "n", "threshold", "rank"):
        docs = docs.withColumn(name, F.lit("z"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert found(queries.op12_phrase_collocations(spark, str(tmp_path))) == brute_top(rows, 2000, 30)
    empty = collocations.top_phrases(brute.documents(spark, []))
    assert empty.columns == COLUMNS and empty.count() == 0
