"""Operator 12 against a plain tree, and its SQL."""
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusprep.llm import merkle, queries
from corpusprep.llm.merkle import Append, fold, merkle_manifest, verify


def _sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _leaf(values):
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _tree(nodes, arity):
    """(root, per leaf its siblings level by level)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            first = k - k % arity
            proofs[leaf].append((k % arity, "".join(h for i, h in enumerate(nodes[first: first + arity], first) if i != k)))
        nodes = [_sha("".join(nodes[i: i + arity])) for i in range(0, len(nodes), arity)]
        at = [k // arity for k in at]
    return nodes[0], proofs


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_appended_tree_equals_plain_tree(arity):
    for n in [*range(1, 40), 255, 256, 257, 300]:
        nodes = [_sha(str(i)) for i in range(n)]
        root, proofs = _tree(nodes, arity)
        tree, bare = Append(arity), Append(arity, watch=False)
        for h in nodes:
            tree.add(h)
            bare.add(h)
        assert tree.close() == bare.close() == root
        for i, h in enumerate(nodes):
            assert tree.witness(i) == proofs[i]
            assert fold(h, tree.witness(i)) == root
        assert fold(_sha("other"), tree.witness(0)) != root


def test_witnesses_grow_as_siblings_complete():
    tree = Append(2)
    seen = []
    for i in range(8):
        tree.add(_sha(str(i)))
        seen.append(len(tree.witness(0)))
    assert seen == [0, 1, 1, 2, 2, 2, 2, 3]


def _plain(rows, arity, fields):
    """Expected (position, leaf, subroot, root, witness) of rows given as dicts."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    tops, held = [], {}
    for g in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        mine = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, _leaf([r[f] for f in fields])) for r in groups[g]))
        held[g] = mine
        tops.append((g, *_tree([h for *_, h in mine], arity)))
    root, above = _tree([t[1] for t in tops], arity)
    out = []
    for (g, sub, proofs), up in zip(tops, above):
        for k, ((some, i, h), proof) in enumerate(zip(held[g], proofs)):
            out.append((i if some else None, g, k, h, sub, root, tuple(proof + up)))
    return out


def _got(frame):
    return sorted(((r.doc_id, r.source, r.position, r.leaf, r.subroot, r.root, tuple((p.place, p.others) for p in r.witness)) for r in frame.collect()), key=repr)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, pos int, total string, g int, node string, witness int, id string"


def _odd_rows():
    rng = random.Random(9)
    rows = [dict(doc_id=i, source=rng.choice(["hot", "hot", "hot", "b", "é", None, ""]), lang=rng.choice([None, "en"]), n_chars=rng.choice([None, 3]),
                 text=rng.choice([None, "", "Ab", "é漢😀"])) for i in range(150)]
    rows += [dict(doc_id=7, source="hot", lang=None, n_chars=1, text="tie")] * 9 + [dict(doc_id=None, source="b", lang="x", n_chars=None, text=None)] * 3
    rows += [dict(doc_id=-5, source="alone", lang="x", n_chars=0, text="L" * 200_000), dict(doc_id=None, source=None, lang=None, n_chars=None, text=None)]
    return [r | dict(pos=1, total="t", g=2, node="n", witness=3, id="i") for r in rows]


@pytest.mark.parametrize("arity,depth", [(2, 1), (2, 3), (3, 2), (16, 3)])
def test_manifest_of_odd_rows(spark, arity, depth):
    """Nulls, ties, repeated rows, clashing names; groups of one and of many blocks."""
    rows = _odd_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = merkle_manifest(frame, arity=arity, depth=depth)
    assert _got(got) == sorted(_plain(rows, arity, merkle.FIELDS), key=repr)
    folded = verify(got).select("folded_root", "root").distinct().collect()
    assert len(folded) == 1 and folded[0].folded_root == folded[0].root


def test_empty_table_and_bad_parameters(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle_manifest(empty).count() == 0
    with pytest.raises(ValueError):
        merkle_manifest(empty, arity=1)
    with pytest.raises(ValueError):
        verify(merkle_manifest(empty), name="leaf")


def test_a_changed_row_is_found(spark):
    rows = [dict(r, doc_id=i) for i, r in enumerate(_odd_rows())]
    frame = spark.createDataFrame(rows, SCHEMA)
    bad = merkle.leaf_digest({f: F.col(f) for f in merkle.FIELDS} | {"text": F.concat("text", F.lit("!"))})
    got = verify(merkle_manifest(frame, extra={"bad": F.when(F.col("doc_id") % 3 == 0, bad)}).withColumn("now", F.coalesce("bad", "leaf")), "now")
    assert {r.doc_id: r.folded_root == r.root for r in got.collect()} == {r["doc_id"]: r["doc_id"] % 3 != 0 or r["text"] is None for r in rows}


def test_scratch_tables_go(spark, tmp_path):
    import os

    from corpusprep.session import checkpoint_dir
    at = os.path.join(checkpoint_dir(spark).replace("file:", ""), "corpusprep")
    before = set(os.listdir(at)) if os.path.isdir(at) else set()
    merkle_manifest(spark.createDataFrame(_odd_rows(), SCHEMA), arity=2, depth=2).collect()
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(at)) - before}
    assert left <= {"merkle-blocks", "merkle-tops"}


def test_query_and_sql_on_the_whole_table(spark):
    import duckdb

    got = queries.op12_merkle_manifest(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, got.collect()))
    rows = [r.asDict() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    text = {r["doc_id"]: r for r in rows}
    want = []
    for i, _, _, leaf, sub, root, witness in _plain(rows, 16, merkle.FIELDS):
        r = dict(text[i])
        if zlib.crc32(str(i).encode()) % 5 == 0:
            r["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
        folded = fold(_leaf([r[f] for f in merkle.FIELDS]), witness)
        want.append((i, leaf, sub, root, _sha("".join(o for _, o in witness)), folded, folded == root))
    assert got == sorted(want) and 0 < sum(not w[-1] for w in want) < len(want) / 3
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert sorted(con.sql(queries.ORACLE["op12_merkle_manifest"]).fetchall()) == got
