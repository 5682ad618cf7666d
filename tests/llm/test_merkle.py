import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ticklake.llm import merkle
from ticklake.llm.merkle import Append, manifest

sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
SCHEMA = "doc_id long, lang string, text string, tree string, pos long, n long, digest string, block int, root string, id int, carry string, lefts string"


def plain(leaves):
    """Root and witness (lists of left and right siblings) of each leaf, level by level."""
    level, members, found = list(leaves), [[i] for i in range(len(leaves))], [([], []) for _ in leaves]
    while len(level) > 1:
        above, groups = [], []
        for at in range(0, len(level), 8):
            run = level[at : at + 8]
            for k in range(len(run)):
                for i in members[at + k]:
                    found[i][0].append("".join(run[:k]))
                    found[i][1].append("".join(run[k + 1 :]))
            above.append(sha("".join(run)))
            groups.append([i for m in members[at : at + 8] for i in m])
        level, members = above, groups
    return level[0], found


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 513, 700])
def test_appends_extend_witnesses(n):
    leaves = [sha(str(i)) for i in range(n)]
    tree = Append()
    witnesses = [tree.append(x) for x in leaves]
    root, found = plain(leaves)
    assert tree.finish() == root and [Append.siblings(w) for w in witnesses] == found


def test_partial_witnesses_grow_with_each_sibling():
    tree, leaves = Append(), [sha(str(i)) for i in range(20)]
    first = tree.append(leaves[0])
    for i, x in enumerate(leaves[1:8], 1):
        tree.append(x)
        assert first.right == "".join(leaves[1 : i + 1])
    assert first.up is not None and first.up.right == ""  # the run is complete and open above
    for x in leaves[8:16]:
        tree.append(x)
    assert first.up.right == sha("".join(leaves[8:16]))


def value(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


@pytest.mark.parametrize("levels, n", [(4, 300), (1, 700), (2, 300)])
def test_manifest_equals_plain_trees(spark, levels, n):
    r = random.Random(4)
    rows = [(i, r.choice(["en"] * 8 + ["de", None, "é", "", "zz"]), r.choice(["Text", "", None, "ä B" * 5]) and f"Text {i}") for i in r.sample(range(-50, 5000), n)]
    rows += [(6000 + i, f"l{i:03d}", "A") for i in range(100)] + [(7, "en", "same"), (7, "en", "same"), (7, "en", "other"), (None, "en", "x"), (None, None, None), (8, None, "N")]
    docs = spark.createDataFrame([(*x, "t", 1, 2, "d", 3, "r", 4, "c", "l") for x in rows], SCHEMA)
    fields = ["doc_id", "lang", "text"]
    tampered = F.when(F.col("doc_id") % 3 == 0, merkle.leaf(F.col("doc_id"), F.col("lang"), F.lower("text")))
    out = manifest(docs, fields, carry={"tampered": tampered, "n": F.col("n")}, levels=levels)
    out = out.withColumns({"proof": merkle.proof(), "folded": merkle.folded(F.col("leaf")), "changed": merkle.folded(F.coalesce("tampered", "leaf"))})
    trees = {}
    for i, lang, text in rows:
        trees.setdefault(lang, []).append((i is not None, i or 0, sha("".join(map(value, (i, lang, text)))), i, text))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    roots = {lang: plain([x[2] for x in sorted(trees[lang], key=lambda x: x[:3])]) for lang in order}
    root, above = plain([roots[lang][0] for lang in order])
    expected = []
    for lang, (left, right) in zip(order, above):
        for (_, _, digest, i, text), (a, b) in zip(sorted(trees[lang], key=lambda x: x[:3]), roots[lang][1]):
            siblings = "".join(x + y for x, y in zip(a + left, b + right))
            same = i is None or i % 3 or text is None or text == text.lower()
            expected.append((i, digest, roots[lang][0], root, sha(siblings), root, bool(same), 2))
    got = [(x.doc_id, x.leaf, x.subroot, x.root, x.proof, x.folded, x.changed == x.root, x.n) for x in out.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert 0 < sum(not x[6] for x in got) < len(got)


def test_an_empty_table_and_a_single_row(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert manifest(docs, ["text"]).count() == 0
    one = manifest(spark.createDataFrame([(1, None, None)], docs.schema), ["text"]).first()
    assert one.leaf == one.subroot == one.root == sha("-") and one.lefts == one.rights == []
