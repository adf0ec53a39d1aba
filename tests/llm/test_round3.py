"""Spelling variants, conversation repair and sharding against plain versions, on the
edge cases that their docstrings define, and against their oracles."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("sf", [SF001, SF01])
@pytest.mark.parametrize("key", ["op11_spelling_variants", "op12_conversation_repair", "op13_sharding"])
def test_oracle(spark, key, sf):
    import duckdb

    from postlens.llm import registry

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = registry.all_queries()[key](spark, sf)
    rel = con.sql(registry.all_oracles()[key])
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
    assert {c: kinds[t] for c, t in got.dtypes} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    want = sorted((tuple(r[rel.columns.index(c)] for c in got.columns) for r in rel.fetchall()), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want


# ------------------------------------------------------------------ op11
def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, lead=2):
    near = defaultdict(set)
    for w in words:
        near[w] = {v for v in words if v != w and one_edit(w, v)}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= lead * words[w]:
            form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None)
    return out


@pytest.mark.parametrize("letters,shortest,count,crowd", [("ab", 5, 300, 20_000), ("ab", 5, 120, 3), ("abé", 2, 150, 1), ("abcdefg", 5, 250, 2)])
def test_variants(spark, letters, shortest, count, crowd):
    from postlens.llm.variants import spelling_variants

    rnd = random.Random(count)
    words = {}
    while len(words) < count:
        words["".join(rnd.choice(letters) for _ in range(rnd.randrange(shortest, shortest + 6)))] = rnd.randrange(1, 60)
    if crowd > 100:  # long words, and a chain of forms
        words |= {"a" * 700: 3, "a" * 701: 9, "a" * 350 + "b" + "a" * 350: 4, "chain": 1, "chaix": 2, "chayx": 4, "shayx": 8, "\U0001f600" * 5: 3, "\U0001f600" * 6: 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(df, length=shortest, crowd=crowd).collect()}
    assert got == brute_variants(words)


def test_damaged_words(spark):
    from postlens.llm.variants import damaged_words, spelling_variants

    texts = [(i, f"Straße ÉTÉS straße Hello hello, hello{i} ab_cde word{'s' * (i % 3)} " * 2, None) for i in range(300)]
    texts += [(1, None, None), (None, "hello hello nulls", None), (2, "", None), (2, "é" * 5000 + " 12 .", None), (7, "same rows here", None), (7, "same rows here", None)]
    df = spark.createDataFrame(texts, "doc_id long, text string, word string").selectExpr("*", "1 AS n", "'x' AS i", "'y' AS t")
    want = Counter()
    for i, t, _ in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    want = {w: n for w, n in want.items() if n >= 3 and len(w) >= 5}
    assert {r.word: r.n for r in damaged_words(df).collect()} == want
    none = damaged_words(df.limit(0))
    assert none.count() == 0 and spelling_variants(none).count() == 0


# ------------------------------------------------------------------ op12
def brute_repair(rows):
    """Plain strings and minima over (cost, audit); ``rows``: (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        left = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not left else "d" if (role, text) in seen else "t" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def filled(best):
        out = dict(best)
        for _ in range(3):
            for at, (c, a, said) in list(out.items()):
                for x in "ua":
                    if (at, x) in go:
                        v = (c + 3, a + "I", said + (names[x] + ":",))
                        out[go[at, x]] = min(v, out.get(go[at, x], v))
        return out

    best = {"": (0, "", ())}
    for (_, role, text), f in zip(rows, faults):
        new = {}
        for at, (c, a, said) in filled(best).items():
            ways = [(at, (c + 4, a + "D", said))]
            if f not in ("b", "d"):
                c += 3 * (f == "t")
                ways += [(go[at, role[:1]], (c, a + "K", said + (f"{role}:{text}",)))] if (at, role[:1]) in go else []
                ways += [(go[at, x], (c + 3, a + "R", said + (f"{names[x]}:{text}",))) for x in "ua" if (at, x) in go]
            for to, v in ways:
                new[to] = min(v, new.get(to, v))
        best = new
    cost, audit, said = min(v for at, v in filled(best).items() if at in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:])), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def brute_damage(rows):
    out = defaultdict(list)
    space = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        m = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = "user" if m == 4 else space(role), "" if m == 1 else re.sub("[.!?]", "", space(text)) if m == 2 else space(text)
        out[conv] += [(turn, role, text)] * (0 if m == 0 else 2 if m == 3 else 1)
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return {k: brute_repair(v) for k, v in out.items()}


COLS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SAYINGS = ["Yes.", "No!", "why", "so", "", " \n\t", "Is it? ", "end. ", "\U0001f600.", None]


def talks(seed, convs, rows):
    rnd = random.Random(seed)
    return [(rnd.choice(convs), rnd.choice([None, *range(9)]), rnd.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None]), rnd.choice(SAYINGS)) for _ in range(rows)]


def repair_rows(df):
    from postlens.llm.repair import repair_digest

    return {r.conv_id: tuple(r[c] for c in COLS) for r in repair_digest(df).collect()}


def test_repair(spark):
    rows = talks(5, [None, 1 << 60, *range(40)], 400)
    rows += [(99, t, None, None) for t in (3, 3, None)] + [(98, 5, "user", "hi " * 40_000 + ".")] + [(97, t, "user", "x.") for t in range(300) if zlib.crc32(f"97:{t}".encode()) % 20 == 0]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS key", "2 AS part", "'z' AS audit")
    got = repair_rows(df.repartition(5))
    want = brute_damage(rows)
    assert got == want
    assert got[97] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair_rows(df.limit(0)) == {}


def test_repair_in_pieces(spark, monkeypatch):
    """Long conversations go through pieces of a few rows and give the same."""
    from postlens.llm import repair

    monkeypatch.setattr(repair, "ROWS", 3)
    rows = talks(6, [1, 1, 1, 2, 3, 4], 260)
    rows = [(c, None if t is None else i, r, x) for i, (c, t, r, x) in enumerate(rows)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = brute_damage(rows)
    # workers import the module afresh, so the pieces are cut here
    summed, told = repair._summaries, {}
    for conv in {r[0] for r in rows}:
        said = damaged_of(rows, conv)
        seen, o = set(), []
        for i, (turn, role, text) in enumerate(said):
            f = repair.fault(text)
            f = repair.DUPLICATE if f != repair.BLANK and (role, text) in seen else f
            seen.add((role, text))
            o.append({"key": str(conv), "part": i // 12, "seq": i % 12 // 3, "initial": role[:1], "fault": f, "turn": turn})
        told[conv] = next(r for r in repair._folds(summed(iter(o))) if "audit" in r)
    assert {c: tuple(t[k] for k in COLS[:-1]) for c, t in told.items()} == {c: w[:-1] for c, w in want.items()}
    assert repair_rows(df.repartition(3)) == want


def damaged_of(rows, conv):
    out = []
    for c, turn, role, text in rows:
        m = zlib.crc32(f"{c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = "user" if m == 4 else " " if role is None else role, " " if text is None else text
        out += [(turn, role, "" if m == 1 else re.sub("[.!?]", "", text) if m == 2 else text)] * (0 if m == 0 else 2 if m == 3 else 1) if c == conv else []
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


def test_a_conversation_over_many_partitions(spark):
    """Over 512 rows, dealt over several ranges: pieces, folds, streamed digest."""
    from postlens.llm.repair import Repair, damaged

    rnd = random.Random(8)
    rows = [(7 if i % 4 else i, i // 2, rnd.choice(["user", "assistant", "tool"]), rnd.choice([f"said {rnd.randrange(900)}.", "cut off", " "])) for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    assert repair_rows(df) == brute_damage(rows)
    fixed = Repair(damaged(df)).repaired().orderBy("key", "part", "seq", "i", "j").collect()
    lines = [f"{r.role}:{r.text}" for r in fixed if r.key == "7"]
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == brute_damage(rows)[7][-1]


# ------------------------------------------------------------------ op13
def shards_of(spark, leaves, n=4000):
    from pyspark.sql import functions as F

    from postlens.llm.sharding import descend

    return [r.s for r in spark.range(n, numPartitions=2).select("id", descend(F.col("id").cast("string"), leaves).alias("s")).orderBy("id").collect()]


def test_shard_law_and_weights(spark):
    from postlens.llm.sharding import topology

    one, more, two = (shards_of(spark, topology(n)) for n in (16, 17, 18))
    assert set(one) == set(range(16)) and all(a == b or b == 16 for a, b in zip(one, more)) and all(a == b or b == 17 for a, b in zip(more, two))
    assert abs(more.count(16) / 4000 - 1 / 17) < 0.015 and all(abs(one.count(s) / 4000 - 1 / 16) < 0.02 for s in range(16))
    # a heavier shard draws rows into its own subtrees only
    heavy = topology(16) | {"1.1.12": 3.0}
    place = {int(p.rsplit(".", 1)[1]): p.split(".") for p in heavy}
    moved = [(place[a], place[b]) for a, b in zip(one, shards_of(spark, heavy)) if a != b]
    assert moved
    for a, b in moved:
        assert b[0] == "1" and (a[0] != "1" or b[1] == "1") and (a[:2] != ["1", "1"] or b[2] == "12")
    assert 12 not in shards_of(spark, topology(16) | {"1.1.12": 0.0}, 500)


def test_shard_table(spark, tmp_path):
    from postlens.llm.sharding import shard_table, topology, write_shards

    rows = [(i % 50 if i % 3 else 5, ["", None, "é" * i, "same"][i % 4], "x") for i in range(400)] + [(None, "n", "y")] * 7 + [(1, "long " * 50_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").selectExpr("*", "1 AS slot", "2 AS key", "3 AS n", "4 AS part")
    out = shard_table(df.repartition(6))
    got = out.collect()
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    at = defaultdict(set)
    for r in got:
        at[r.doc_id].add((r.shard, r.grown_shard))
    assert all(len(v) == 1 and {(s, g) for s, g in v if g not in (s, 16)} == set() for v in at.values())
    for s, slots in ((s, sorted(r.slot for r in got if r.shard == s)) for s in {r.shard for r in got}):
        assert slots == list(range(len(slots))), s
    again = shard_table(df.repartition(3)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    assert shard_table(df.limit(0)).count() == 0
    write_shards(df, f"{tmp_path}/s", topology(16))
    back = spark.read.parquet(f"{tmp_path}/s")
    assert Counter((r.doc_id, r.text, r.shard) for r in back.collect()) == Counter((i, t, next(iter(at[i]))[0]) for i, t, _ in rows)


# ------------------------------------------------------------------ mended operators
def test_near_duplicates_of_one_id(spark):
    """Other texts of one id are other documents; the least (id, text hash) stays."""
    from postlens.llm.simhash import drop_near_duplicates

    rows = [(5, "one two three four", "b"), (5, "quite another text here now", "a"), (6, "one two three four", "a"), (None, "one two three four", "z"),
            (5, "quite another text here now", "0"), (None, "no id at all here", "q"), (7, None, "n"), (8, "", "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "map('k', source) AS fp")
    got = drop_near_duplicates(df)
    assert got.columns == df.columns
    assert {(r.doc_id, r.text, r.source) for r in got.collect()} == {rows[0], rows[4], rows[5], rows[6]}
    assert drop_near_duplicates(df.repartition(7)).count() == 4


def test_quality_learns_from_whole_texts(spark):
    """Junk behind many clean lines is learnt from; a bound on lines leaves documents out, not lines."""
    from postlens.llm.quality import quality_scores, train

    good = "A plain sentence stands here, as it should.\n"
    rows = [(i, good * (300 if i < 150 else 3) + ("$$$ !!! 000 ||| @@@\n" * 900 if i < 150 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i >= 150)) for i, _ in rows], "doc_id long, quality int")
    model = train(docs, labels)
    assert model.unary is not None
    probe = spark.createDataFrame([(1, good * 40), (2, "$$$ !!! 000 ||| @@@\n" * 40)], "doc_id long, text string")
    score = {r.doc_id: r.score for r in quality_scores(docs, labels).filter("doc_id in (0, 1, 298, 299)").collect()}
    assert score[0] < 0.3 and score[299] > 0.5
    assert train(docs, labels, max_lines=10) is not None and probe.count() == 2
