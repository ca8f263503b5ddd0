import zlib
from collections import defaultdict

import brute
import pytest

from landroll.llm import prefixtrie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    """One tuple per node, in the order of the query's columns."""
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [(r, t) for _, _, r, t in sorted(ts, key=lambda t: t[:2])] for c, ts in given.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (c % 20 if c >= 0 else -(-c % 20))
        path = tuple(given.get(first, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, cs in members.items():
        own = (len(cs) - 1) * (len(brute.words(p[-1][1])) if p else 0)
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own
    return sorted((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
                   brute.sha(",".join(map(str, sorted(ends[p]))))) for p, cs in members.items())


def found(df):
    rows = df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                     "ends_sha256").collect()
    return sorted(tuple(r) for r in rows)


def conversations():
    rows = []
    for c in range(0, 130):
        n = (c * 7) % 9 + 1
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"say {c % 3} word {t}" if t < 2 else f"t{c % 5} {t}")
                 for t in range(n)]
    rows += [(c, t, "user", f"deep {t // 70 * (c % 2)}") for c in (200, 201, 202, 241) for t in range(150)]
    rows += [(c, t, "user", f"deep {t}") for c in (400, 401, 603, 607, 611) for t in range(70)]
    rows += [(300, None, None, None), (300, 5, "user", ""), (301, 5, None, "a b"), (-45, 0, "user", "x"), (-45, 1, "user", "y"),
             (-40, 0, "user", "x"), (None, 0, "user", "lost"), (500, 1, "u", "same"), (500, 1, "u", "same")]
    # Conversations whose turns all fall into the head of a group that has none.
    rows += [(c, 0, "user", "alone") for c in range(1001, 1010)]
    return rows


def test_equals_brute_force(spark):
    rows = conversations()
    assert found(prefixtrie.trie(spark.createDataFrame(rows, SCHEMA))) == brute_trie(rows)


@pytest.mark.parametrize("block, band, group_rows, ids", [(16, 2, 40, 4), (8, 4, 0, 1)])
def test_hot_groups_blocks_and_bands(spark, monkeypatch, block, band, group_rows, ids):
    """Every route that only large input takes: groups by ranges, sums over several levels of blocks, many bands."""
    for name, value in (("BLOCK", block), ("BAND", band), ("GROUP_ROWS", group_rows), ("IDS", ids)):
        monkeypatch.setattr(prefixtrie, name, value)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(prefixtrie.trie(df)) == brute_trie(rows)


def test_groups_of_copies_and_hot_first_turn(spark):
    rows = [(c, t, "user", "the same") for c in range(3000) for t in range(2)]
    rows += [(c, t, "user", "the same" if t == 0 else f"other {c}") for c in range(3000, 4000) for t in range(3)]
    assert found(prefixtrie.trie(spark.createDataFrame(rows, SCHEMA))) == brute_trie(rows)


def test_equal_turn_numbers_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, 0, "user", str(k % 7)) for k in range(30)] + [(21, None, "user", str(k)) for k in range(9)]
    a = found(prefixtrie.trie(spark.createDataFrame(rows, SCHEMA)))
    assert a == found(prefixtrie.trie(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)))
    assert max(r[1] for r in a) == 30 - zlib.crc32(b"1") % 4


def test_extra_columns_and_empty_table(spark, tmp_path):
    rows = conversations()[:60]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("group", "node", "depth", "line", "words", "last", "a", "x", "h", "position", "n_convs"):
        df = df.selectExpr("*", f"'z' as `{name}`")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    assert found(queries.op13_conversation_prefix_trie(spark, str(tmp_path))) == brute_trie(rows)
    assert prefixtrie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_totals_copy_a_value_at_most_band_times(spark):
    turns, deepest = prefixtrie.rebuilt(spark.createDataFrame(conversations(), SCHEMA))
    lines = prefixtrie.prefixes(turns, deepest).selectExpr("max(size(line)) as n").first().n
    assert lines == prefixtrie.BAND
