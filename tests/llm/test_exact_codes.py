"""Manifest, secret scan and vector codes against plain versions."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm import automata, codes, manifest, oracles, queries, secret_scan


@pytest.mark.parametrize("name", ["op11_manifest", "op12_secrets", "op13_codes"])
def test_queries_equal_sql(spark, sf_dir, name):
    engine = duckdb.connect()
    for t in ("documents", "embeddings"):
        engine.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = engine.execute(oracles.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    found = queries.QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(columns)
    rows = sorted(map(repr, map(tuple, found.select(*columns).collect())))
    assert rows and rows == sorted(map(repr, cursor.fetchall()))


# --- manifest -----------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves):
    """(root, proof of each leaf as (slot, siblings) a level)."""
    proofs, owners, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        above, held = [], []
        for low in range(0, len(nodes), 3):
            run = nodes[low : low + 3]
            for slot in range(len(run)):
                for i in owners[low + slot]:
                    proofs[i].append((slot, run[:slot] + run[slot + 1 :]))
            above.append(sha("".join(run)))
            held.append([i for o in owners[low : low + 3] for i in o])
        nodes, owners = above, held
    return nodes[0], proofs


def plain_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root) of (doc_id, text, lang, source, n_chars, got)."""

    def leaf(r, text):
        parts = (r[0], r[3], r[2], r[4], text)
        return sha("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))

    groups = {}
    for r in rows:
        groups.setdefault(b"" if r[3] is None else b"1" + r[3].encode(), []).append((r[0], leaf(r, r[1]), leaf(r, r[5])))
    names = sorted(groups)
    trees = []
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(plain_tree([x[1] for x in groups[name]]))
    root, upper = plain_tree([t[0] for t in trees])
    out = []
    for name, (subroot, proofs), top in zip(names, trees, upper):
        for (key, digest, got), proof in zip(groups[name], proofs):
            folded = got
            for slot, siblings in proof + top:
                folded = sha("".join(siblings[:slot] + [folded] + siblings[slot:]))
            out.append((key, digest, subroot, root, [s for _, s in proof + top], folded))
    return sorted(out, key=repr)


def found_manifest(docs, **options):
    got = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    got = got.otherwise(F.col("text"))
    rows = manifest.merkle_manifest(docs, received={"text": got}, **options).collect()
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    for r in rows:
        assert manifest.fold(r.leaf, r.slots, r.proof) == r.root
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in rows), key=repr)


def received(key, text):
    damaged = key is not None and zlib.crc32(str(key).encode()) % 2 == 0
    return text.replace("\n", "") if damaged and text is not None else text


def with_received(rows):
    return [(*r[:5], received(r[0], r[1])) for r in rows]


def test_manifest_of_edges(spark, edge, nothing):
    rows = [tuple(r)[:5] for r in edge.collect()]
    assert found_manifest(edge) == plain_manifest(with_received(rows))
    assert found_manifest(edge.repartition(7), levels=1) == plain_manifest(with_received(rows))
    assert manifest.merkle_manifest(nothing).count() == 0


@pytest.mark.parametrize("size", [1, 3, 4, 28, 82])
def test_manifest_of_every_depth(spark, size):
    """Superblocks of three and nine leaves give several layers; ids repeat, one source holds most rows."""
    rng = random.Random(size)
    rows = [
        (rng.choice([None, i // 2, -i, i]), rng.choice([f"a\nb{i}", "same\n", None]), None, rng.choice(["hot"] * 8 + [None, "ß", "z", ""]), i % 5)
        for i in range(size)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    want = plain_manifest(with_received(rows))
    assert found_manifest(docs, levels=1 + size % 2) == want


def test_manifest_of_many_groups_and_copies(spark):
    """The tree over the groups has layers of its own; a row stored fifty times is fifty leaves."""
    rows = [(i, f"t\n{i}", "en", f"s{i}", 1) for i in range(40)] + [(7, "copy\n", "en", "s7", 1)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = found_manifest(docs, levels=1)
    assert found == plain_manifest(with_received(rows))
    assert 0 < sum(r[5] != r[3] for r in found) < len(rows)


# --- secrets ------------------------------------------------------------------


def plain_spans(text):
    out = []
    for k, r in enumerate(secret_scan.RULES):
        head, value = (p.replace("(", "(?:") for p in (r.head, r.value))
        for m in re.finditer(f"(?:{head})({value})", text):
            if m.end() - m.start(1) >= r.least:
                out.append((m.start(), k, m.end()))
    return [(secret_scan.RULES[k].kind, a, b) for a, k, b in sorted(out)]


def secret_texts():
    rng = random.Random(3)
    pieces = ["token", "password", "api_key", "APIKEY", "Secret", '"', "'", " ", "=", ":", "abcdef0123456789", "AKIA", "ABCD12", "é",
              "😀", "x", "\n", "-----BEGIN ", "RSA ", "PRIVATE KEY", "-----", "ghp_", "eyJ", ".", "AIza", "0" * 20, "sk_live_", "xoxb-",
              "_", "9aZ", "ſecret", "toKen"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    # A failed match hides what it covers; the same match twice; very long texts and runs.
    texts += ["password=token: abcdefghij", "token=short token=longenough", "a" * 200_000, "token=" + "z" * 100_000,
              "AKIA" + "AKIA" * 40, "f" * 31, "f" * 32 + "g" + "f" * 33]
    return texts


def test_secrets_equal_regexes(spark):
    texts = secret_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in secret_scan.find_secrets(docs).collect()}
    want = {i: plain_spans(t) for i, t in enumerate(texts)}
    assert found == want
    assert {s[0] for spans in want.values() for s in spans} == {r.kind for r in secret_scan.RULES}


def test_secret_report(spark, edge, nothing):
    docs = spark.createDataFrame(
        [(1, "é token = 'abcdefgh' " + "0" * 32, "x"), (None, None, "y"), (2, "", "z"), (2, "AKIAABCDEFGHIJKL", "z")],
        "doc_id long, text string, spans string",
    )
    rows = secret_scan.secret_report(docs).orderBy("doc_id", "n_access").collect()
    empty = sha("")
    assert [tuple(r) for r in rows] == [
        (None, 0, 0, 0, empty, ""),
        (1, 1, 0, 1, sha("assign:2:19,hex:21:53"), "assign:2:19,hex:21:53"),
        (2, 0, 0, 0, empty, ""),
        (2, 0, 1, 0, sha("access:0:16"), "access:0:16"),
    ]
    assert secret_scan.secret_report(edge).count() == edge.count()
    assert secret_scan.secret_report(nothing).count() == 0


def test_added_rules_leave_the_base_alone(spark):
    texts = secret_texts()[:500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    both = [secret_scan.secret_report(docs, rules=r).select(*columns) for r in (secret_scan.BASE, secret_scan.RULES)]
    assert sorted(both[0].collect()) == sorted(both[1].collect())


@pytest.mark.parametrize("rule", ["a(b|cd)*e?", "[^a-c]{2,3}x", "(ab|a)(c|bcd)", "a{2}|b{0,2}c", "\\[x\\]+", "[]a-]+z", ".b"])
def test_automata_equal_regexes(rule):
    rng = random.Random(rule)
    auto = automata.Automaton([rule])
    for _ in range(300):
        text = "".join(rng.choice("abcdexz[]-\n") for _ in range(rng.randint(0, 12)))
        ends = [e for e in range(len(text) + 1) if re.fullmatch(rule, text[:e])]
        assert auto.longest(text.encode(), 0) == (ends[-1] if ends else -1)


def test_automata_are_minimal():
    """Two spellings of a language have equally many states; unsupported rules are refused."""
    sizes = {len(automata.Automaton([r]).rules) for r in ("(a|b)*abb", "(a*b*)*abb", "(b|a)*a(b)b")}
    assert sizes == {5}
    for rule in ("(a", "\\d", "é", "a)"):
        with pytest.raises(ValueError):
            automata.Automaton([rule])


# --- vector codes -------------------------------------------------------------


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """({position: (code, error)}, codebooks) of (vec_id, vector) by comparing every entry."""
    kept = [(k, v) for k, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(k, [math.floor(4096 * x) for x in v]) for k, v in kept]
    width = len(whole[0][1]) // parts
    order = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[r[1][p * width : (p + 1) * width] for r in order[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    def part(v, p):
        return v[p * width : (p + 1) * width]

    for _ in range(rounds):
        sums = {}
        for _, v in whole:
            for p in range(parts):
                sums.setdefault((p, nearest(p, part(v, p))[1]), []).append(part(v, p))
        for (p, e), held in sums.items():
            books[p][e] = [sum(c) // len(held) for c in zip(*held)]
    out = []
    for k, v in whole:
        near = [nearest(p, part(v, p)) for p in range(parts)]
        out.append((k, bytes(i for _, i in near).hex(), sum(d for d, _ in near)))
    return sorted(out, key=repr), books


def vector_rows():
    rng = random.Random(8)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), 0.0, 0.5]) for _ in range(16)]) for i in range(150)]
    rows += [(i % 7, rows[i][1]) for i in range(60)] + [(900, rows[3][1])] * 80
    rows += [(None, rows[5][1]), (300, None), (301, []), (302, [None] * 16), (303, [float("nan")] + [0.0] * 15),
             (304, [float("inf")] + [0.0] * 15), (305, [0.0] * 16), (306, [1.0, 2.0])]
    return rows


def test_codes_equal_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(k, v, k and k % 3) for k, v in rows], "vec_id long, embedding array<double>, label int")
    want, books = plain_codes([r for r in rows if r[1] is None or len(r[1]) != 2])
    for some in (df, df.repartition(5)):
        coded, found = codes.compress_vectors(some)
        assert found.tolist() == books
        got = coded.collect()
        assert sorted(((r.vec_id, r.code.hex(), r.error) for r in got), key=repr) == want
        by_label = {}
        for r in got:
            by_label[r.label] = by_label.get(r.label, 0) + r.error
    report = codes.code_report(df.withColumn("code", F.lit("x")).withColumn("n", F.lit(1))).collect()
    assert sorted((r.label_error for r in report)) == sorted(by_label[r.label] for r in got)


def test_codes_of_few_and_no_vectors(spark):
    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.StringType())]
    )
    few = spark.createDataFrame([(2, [0.5] * 8, None), (1, [-0.5] * 8, "a")], schema)
    rows = sorted(codes.code_report(few).collect())
    assert [(r.vec_id, r.code, r.error) for r in rows] == [(1, "00" * 8, 0), (2, "01" * 8, 0)]
    none = spark.createDataFrame([(1, None, "a")], schema)
    assert codes.code_report(none).count() == 0
    with pytest.raises(Exception, match="too large"):
        codes.code_report(spark.createDataFrame([(1, [1e30] * 8, "a")], schema)).collect()


def test_decoded_vectors_are_near(spark):
    rng = np.random.default_rng(2)
    centres = rng.uniform(-1, 1, (10, 32))
    rows = [(i, (centres[i % 10] + rng.normal(0, 0.001, 32)).tolist(), i % 10) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    coded, books = codes.compress_vectors(df, entries=32)
    back = {r.vec_id: np.array(r.approximate) for r in codes.decode_vectors(coded, books).collect()}
    assert max(np.abs(back[i] - v).max() for i, v, _ in rows) < 0.01


def test_search_equals_a_full_scan():
    """Few distinct values, so that ties and equal entries abound."""
    rng = np.random.default_rng(1)
    for _ in range(100):
        entries = rng.integers(-3, 4, (rng.integers(1, 17), rng.integers(1, 5)))
        points = rng.integers(-4, 5, (200, entries.shape[1]))
        near, far = codes.Codebook(entries).nearest(points)
        all_far = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (near == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()
