import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from meterloom.llm import common, sharding
from meterloom.llm.sharding import Cell
from tests.conftest import SF

key_of = lambda t: int(sha256((t or "").encode()).hexdigest()[:15], 16)


def brute(texts, shards, overhead=16):
    """Key -> shard: large groups alone, the others by trying capacities upwards."""
    size = Counter()
    for t in texts:
        size[key_of(t)] += len((t or "").encode()) + overhead
    own, rest = [], sum(size.values())
    for k, s in sorted(size.items(), key=lambda x: (-x[1], x[0])):
        if len(own) == shards - 1 or s * (shards - len(own)) <= rest:
            break
        own.append(k)
        rest -= s
    others, left = sorted(k for k in size if k not in own), shards - len(own)
    capacity = max([-(-rest // left), *[size[k] for k in others]]) if others else 0
    while True:
        shard, load, out = 0, 0, {}
        for k in others:
            if load + size[k] > capacity:
                shard, load = shard + 1, 0
            load += size[k]
            out[k] = shard + len(own)
        if shard < left:
            return out | {k: i for i, k in enumerate(own)}
        capacity += 1


def check(rows, texts, shards):
    want = brute([t for _, t in texts], shards)
    crc = lambda t: zlib.crc32((t or "").encode())
    expected = Counter((d, len((t or "").encode()) + 16, crc(t), want[key_of(t)]) for d, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in rows) == expected
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


@pytest.mark.parametrize("bits", [14, 1])
def test_exact_and_whole(spark, monkeypatch, bits):
    """Few bits make cells of many groups, which are split further, down to the one a cut needs."""
    monkeypatch.setattr(sharding, "FIRST_BITS", bits)
    rng = random.Random(bits)
    texts = [(i, "".join(rng.choice("abcé ") for _ in range(rng.choice([3, 40, 200])))) for i in range(900)]
    texts += [(1000 + i, "copy of one") for i in range(400)] + [(i, texts[i][1]) for i in range(30)] + [(None, None), (None, ""), (5, None)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    for shards in (1, 2, 7, 40):
        check(sharding.shards_by_bytes(docs, shards).collect(), texts, shards)


def test_a_third_of_all_rows_in_one_group(spark):
    """The large group has its shard, and the others are as near to each other as their groups allow."""
    texts = [(i, "the same words again and again") for i in range(500)] + [(500 + i, f"text number {i}") for i in range(1000)]
    rows = sharding.shards_by_bytes(spark.createDataFrame(texts, "doc_id long, text string"), 8).collect()
    check(rows, texts, 8)
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    small = sorted(load.values())[:-1]
    assert len(load) == 8 and small[-1] - small[0] < 7 * 2 * 31


def test_bisection_against_all_capacities():
    rng = random.Random(4)
    for _ in range(200):
        cells = [Cell(i, i, rng.randint(1, 30)) for i in range(rng.randint(1, 12))]
        for shards in (1, 2, 3, 5):
            least = next(c for c in range(400) if sharding.filled(cells, c, shards, False)[1])
            assert sharding.least_capacity(cells, shards, False) == least == sharding.least_capacity(cells, shards, True)
            assert not sharding.undecided(cells, shards)


def test_cells_of_several_groups_are_split_until_cuts_are_certain():
    rng = random.Random(5)
    for _ in range(200):
        groups = [Cell(i, i, rng.randint(1, 30)) for i in range(64)]
        merge = lambda part: Cell(part[0].low, part[-1].high, sum(c.size for c in part))
        cells, shards = [merge(groups[i : i + 8]) for i in range(0, 64, 8)], rng.randint(1, 9)
        while split := sharding.undecided(cells, shards):
            cells = [x for i, c in enumerate(cells) for x in (groups[c.low : c.high + 1] if i in split else [c])]
        least = sharding.least_capacity(cells, shards, True)
        assert least == sharding.least_capacity(groups, shards, False)
        assert sharding.filled(cells, least, shards, True)[0] == sharding.filled(groups, least, shards, False)[0]


def test_edges(spark, edge_docs, no_docs):
    rows = sharding.shards_by_bytes(edge_docs, 5).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in edge_docs.collect()], 5)
    assert sharding.shards_by_bytes(no_docs, 5).collect() == []
    one = sharding.shards_by_bytes(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in one] == [(1, 16, 0, 0, 0)]


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 3, 4, 5, 6)], "`the.id` long, text string, doc_id long, key long, task int, shard int")
    assert [tuple(r) for r in sharding.shards_by_bytes(docs, 3, id_col="the.id").collect()] == [(1, 19, zlib.crc32(b"a b"), 0, 0)]


def test_query_as_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = con.execute(sharding.ORACLE)
    names = sorted(d[0] for d in result.description)
    want = sorted(map(repr, (tuple(r[[d[0] for d in result.description].index(n)] for n in names) for r in result.fetchall())))
    got = sharding.op11_sharding(spark, SF)
    assert sorted(got.columns) == names
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == want


def test_plan_has_no_python(spark):
    plan = sharding.op11_sharding(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_cuts_may_fall_in_thousands_of_runs(spark, monkeypatch):
    """Every other cell is read again; a condition for each of them would nest thousands deep."""
    half = 1 << (sharding.KEY_BITS - sharding.FIRST_BITS - 1)
    rows = spark.range(2 << sharding.FIRST_BITS).select((F.col("id") * half).alias("key"), (F.col("id") % 97 + 16).alias("size"))
    found = sharding.undecided
    rounds = [lambda cells, shards: list(range(0, len(cells), 2))]
    monkeypatch.setattr(sharding, "undecided", lambda *a: (rounds.pop() if rounds else found)(*a))
    got, keys = sharding.cut_keys(rows, [], 4), [(i * half, i % 97 + 16) for i in range(2 << sharding.FIRST_BITS)]
    load, want, most = 0, [], sharding.least_capacity([Cell(k, k, s) for k, s in keys], 4, False)
    for i, (_, s) in enumerate(keys):
        if load + s > most:
            want.append(keys[i - 1][0])
            load = 0
        load += s
    assert got == want
