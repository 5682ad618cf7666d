import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from ticklake.llm import mixing, sharding
from ticklake.llm.mixing import mixed_documents, mixture
from ticklake.llm.queries import ORACLE
from ticklake.llm.sharding import _Tree, best_fit, bins_of, pack, pack_into, sharded


def test_tree_gives_the_tightest_bin():
    r, tree, plain = random.Random(1), _Tree(), []
    for i in range(400):
        tree.insert(c := r.randrange(50), i)
        plain.append((c, i))
    for _ in range(400):
        least = r.randrange(60)
        fit = [x for x in plain if x[0] >= least]
        assert tree.take(least) == (min(fit) if fit else None)
        if fit:
            plain.remove(min(fit))


def histogram(sizes):
    return sorted(Counter(sizes).items(), reverse=True)


def bins_by_item(packed):
    """The bin of each item, in the order of the sizes."""
    return [first + i // per for runs in packed for n, per, first in runs for i in range(n)]


def plain_best_fit(sizes, capacity, bins):
    left, out = [], []
    for s in sorted(sizes, reverse=True):
        fit = [(c, i) for i, c in enumerate(left) if c >= s]
        if s > capacity or (not fit and len(left) == bins):
            return None
        i = min(fit)[1] if fit else len(left)
        left[i:] = left[i:] if fit else [capacity]
        left[i] -= s
        out.append(i)
    return out


@pytest.mark.parametrize("most", [5, 100])
def test_best_fit_of_a_histogram_is_that_of_each_item(most):
    sizes = [random.Random(2).randrange(1, most) for _ in range(300)]
    sizes += [random.Random(most).randrange(1, most) for _ in range(100)]
    for capacity in (120, 131, 1000, 2000):
        for bins in (8, 16, 400):
            found, plain = best_fit(histogram(sizes), capacity, bins), plain_best_fit(sizes, capacity, bins)
            assert (found is None) == (plain is None)
            if found is not None:  # equal sizes are interchangeable
                items = sorted(sizes, reverse=True)
                assert sorted(zip(items, bins_by_item(found))) == sorted(zip(items, plain))


def test_pack_and_pack_into():
    sizes = sorted((random.Random(2).randrange(1, 100) for _ in range(300)), reverse=True)
    for given in (sizes, [10_000, *sizes], [5] * 3, [7], [9, 9, 1, 1, 1, 1], [50] * 2 + [1] * 40):
        loads, packed = Counter(), pack(histogram(given), 4)
        for s, b in zip(given, bins_by_item(packed), strict=True):
            loads[b] += s
        assert max(loads) < 4 and max(loads.values()) <= max(given[0], sum(given) / 4 + max(given[-1], 1) + 9)
    for capacity in (99, 150, 1000):
        loads, packed = Counter(), pack_into(histogram([10_000, 5_000, *sizes]), capacity)
        for s, b in zip([10_000, 5_000, *sizes], bins_by_item(packed), strict=True):
            loads[b] += s
        assert sorted(loads) == list(range(bins_of(packed))) and sorted(loads.values())[-2:] == [5_000, 10_000]
        assert sorted(loads.values())[-3] <= capacity
        assert len(loads) - 2 <= -(-sum(sizes) // capacity) * 11 // 9 + 1  # what best fit decreasing guarantees
    assert pack([], 4) == [] and pack_into([], 10) == [] and bins_of([]) == 0


def test_shards_keep_groups_and_number_rows(docs):
    r = random.Random(3)
    rows = [(i, "y" * r.randrange(2000)) for i in range(400)] + [(1000 + i, "same text") for i in range(50)]
    rows += [(2000, None), (2001, ""), (None, "null id"), (5000, "again"), (5000, "again"), (2002, "é" * 50_000)]
    out = sharded(docs(rows), shards=4).collect()
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in out) == sorted((i is None, i or 0) for i, _ in rows)
    text = dict(rows)
    slots, of_text = defaultdict(list), defaultdict(set)
    for x in out:
        data = (text[x.doc_id] or "").encode()
        assert (x.size, x.text_crc32, x.law, x.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        slots[x.shard].append(x.slot)
        of_text[data].add(x.shard)
    assert set(slots) <= set(range(4)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())
    loads = Counter()
    for x in out:
        loads[x.shard] += x.size
    assert max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())
    assert sharded(docs([])).count() == 0


@pytest.mark.parametrize("part_groups", [100_000, 7])
def test_shards_are_those_of_packing_each_group(docs, monkeypatch, part_groups):
    monkeypatch.setattr(sharding, "PART_GROUPS", part_groups)
    r = random.Random(5)
    rows = [(i, f"{i:05d}" + "z" * r.choice([0, 3, 40, 700])) for i in range(300)] + [(900 + i, "copies") for i in range(60)]
    groups = Counter()
    for _, text in rows:
        groups[text] += len(text) + 1
    out = sharded(docs(rows), capacity=5000).collect()
    assert {x.law for x in out} == {"capacity"}
    loads, text = Counter(), dict(rows)
    for x in out:
        loads[x.shard] += x.size
    plain = Counter()
    items = sorted(groups.values(), reverse=True)
    for size, b in zip(items, plain_best_fit(items, 5000, None)):
        plain[b] += size
    assert sorted(loads.values()) == sorted(plain.values()) and max(loads.values()) <= 5000
    assert len({x.shard for x in out if text[x.doc_id] == "copies"}) == 1
    with pytest.raises(ValueError):
        sharded(docs(rows), capacity=0)


def test_beyond_the_exact_sizes_bundles_come_out_alike(docs, monkeypatch):
    rows = [(i, f"text {i} " + "v" * (i % 211)) for i in range(3000)] + [(5000 + i, "hot") for i in range(1500)]
    loads = {}
    for most in (sharding.MAX_SIZES, 10):
        monkeypatch.setattr(sharding, "MAX_SIZES", most)
        monkeypatch.setattr(sharding, "LARGE_SHARE", 100)
        monkeypatch.setattr(sharding, "BUNDLES", 64)
        out = sharded(docs(rows), shards=4)
        assert out.count() == len(rows) and out.where("size = 4").select("shard").distinct().count() == 1
        loads[most] = [r[1] for r in out.groupBy("shard").sum("size").collect()]
    assert all(len(x) == 4 for x in loads.values())
    assert max(loads[sharding.MAX_SIZES]) < 1.1 * min(loads[sharding.MAX_SIZES])
    assert max(loads[100_000]) - min(loads[100_000]) < len("text 0 ") + 1  # the smallest group


def test_shards_do_not_depend_on_the_number_of_sizes(docs, monkeypatch):
    r = random.Random(8)
    rows = [(i, f"{i:04d}" + "u" * r.randrange(900)) for i in range(500)] + [(700 + i, "copies") for i in range(90)]
    monkeypatch.setattr(sharding, "LARGE_SHARE", 100)
    monkeypatch.setattr(sharding, "BUNDLES", 64)
    found = []
    for most in (sharding.MAX_SIZES, 10):  # more sizes than this once were packed in bundles
        monkeypatch.setattr(sharding, "MAX_SIZES", most)
        found.append([sorted(map(tuple, sharded(docs(rows), shards=4, capacity=c).collect())) for c in (None, 3000)])
    assert found[0] == found[1]


ROWS = (
    [(i, "w " * (i % 37), f"s{i % 5}") for i in range(300)]
    + [(1000 + i, "tiny text", "zz") for i in range(3)]
    + [(2000, None, "empty"), (2001, "", "empty"), (2002, "a b c", None), (None, "a b", None), (3, "w w", "s3"), (3, "w w", "s3")]
    + [(3000, "long " * 20_000, "Z"), (3001, "x", "é")]
)


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_mix_equals_sql(docs, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    df = docs(ROWS)
    out = mixture(df.select("doc_id", "source", "text", "hash"))
    got = sorted(map(str, out.select("doc_id", "size", "source_size", "target", "taken").toPandas().astype(object).where(lambda x: x.notna(), None).itertuples(index=False, name=None)))
    documents = df.select("doc_id", "source", "text").toPandas().astype({"doc_id": "Int64"})  # noqa: F841
    rows = duckdb.sql(ORACLE["op4_source_mixing"]).df()
    rows = rows[["doc_id", "size", "source_size", "target", "taken"]].astype(object).where(lambda x: x.notna(), None)
    norm = lambda s: s.replace(".0,", ",")  # noqa: E731  # ids with nulls come as floats
    assert sorted(map(norm, got)) == sorted(norm(str(x)) for x in rows.itertuples(index=False, name=None))


def test_mix_meets_targets_and_repeats_whole_documents(docs):
    df = docs(ROWS)
    out = mixture(df).collect()
    assert len(out) == len(ROWS) and {r.hash for r in out} == {4}
    words, taken, target, most = Counter(), Counter(), {}, Counter()
    for r in out:
        assert r.size == len((r.text or "").split()) and (r.taken in (0, r.size, 2 * r.size, 3 * r.size))
        words[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        most[r.source] = max(most[r.source], r.size)
    for s in words:
        assert target[s] <= 3 * words[s] and abs(taken[s] - target[s]) <= most[s]
    assert sum(target.values()) == pytest.approx(sum(words.values()))
    free = [target[s] / w for s, w in zip(sorted(words, key=lambda x: (x is None, x or "")), [1, 2, 3] * 9) if target[s] < 3 * words[s]]
    assert max(free) == pytest.approx(min(free))
    copies = Counter(r.doc_id for r in mixed_documents(df).collect())
    for r in out:
        assert r.doc_id == 3 or copies[r.doc_id] == (r.taken // r.size if r.size else 0)
    assert mixture(docs([])).count() == 0 and mixed_documents(docs([])).columns == docs([]).columns
