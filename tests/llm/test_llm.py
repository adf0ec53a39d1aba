"""The training-data operators against brute force on small tables, on the edge
cases that their docstrings define, and against their oracles."""

import hashlib
import heapq
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
PASSAGE = " ".join(f"common{i}" for i in range(60))
EDGE = [
    (0, None, "a"), (1, "", "a"), (2, "   \n\t", None), (3, "one", "b"), (4, "One two. three FOUR\nfive", "b"),
    (5, "x " + PASSAGE + " y", "b"), (6, PASSAGE + " z", None), (7, PASSAGE, "c"), (8, PASSAGE, "c"), (9, LONG, "c"),
    (10, "line one here\nline two here\n\nline three", "a"), (11, "zz\nline one here\nline two here\nqq", "a"),
    (12, "é日本 café CAFÉ \U0001f600 12 3.4", None), (12, "é日本 café CAFÉ \U0001f600 12 3.4", None), (None, "no id", "d"), (None, None, None),
    (13, "a" * 1000, "d"), (14, "ab " * 400, "d"), (15, "mail a.b@c.org or +1 (555) 123-4567, host 10.0.0.1, card 4111 1111 1111 1111.", "d"),
]
COLUMNS = ["_id", "_th", "h", "n", "lo", "spans", "score", "size", "w", "target", "votes", "won", "fp", "label", "words", "c"]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if extra:  # extra columns whose names the operators use inside
        df = df.selectExpr("*", "'en' AS lang", *[f"cast(null as string) AS `{c}`" for c in COLUMNS])
    return df


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, EDGE).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def docs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# ------------------------------------------------------------------ oracles
@pytest.mark.parametrize("sf", [SF001, SF01])
@pytest.mark.parametrize("key", ["op1_line_dedup", "op3_topk_search", "op4_decontaminate", "op5_mix_sources"])
def test_oracle(spark, key, sf):
    import duckdb

    from postlens.llm import registry

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = registry.all_queries()[key](spark, sf)
    rel = con.sql(registry.all_oracles()[key])
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert {c: kinds[t] for c, t in got.dtypes} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    want = sorted((tuple(r[rel.columns.index(c)] for c in got.columns) for r in rel.fetchall()), key=repr)
    assert rows_of(got, *got.columns) == want


# ------------------------------------------------------------------ op1
def brute_lines(docs, run=2, long=3):
    """Unique (doc_id, text) in order; later copies removed: ``{id: (text, lines removed)}``."""
    out, seen = {}, set()
    for i, t in sorted(set((i, t or "") for i, t in docs if i is not None)):
        lines = t.split("\n")
        real = [k for k, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for a in range(len(real) - run + 1):
            at = real[a:a + run]
            key = tuple(lines[k] for k in at)
            if key in seen:
                gone |= set(at)
            seen.add(key)
        for k in real:
            if len(re.findall("[^\x20\x09-\x0D]+", lines[k])) > long:
                if (lines[k],) in seen:
                    gone.add(k)
                seen.add((lines[k],))
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)
    return out


def test_long_line_is_a_run_by_itself(spark):
    from postlens.llm.lines import dedup_lines

    words = lambda n, sep=" ": sep.join(f"v{i}" for i in range(n))
    rows = [(1, f"a\n{words(51)}\nb", ""), (2, f"c\n{words(51)}\nd", ""), (3, words(51), ""), (4, f"e\n{words(50)}", ""),
            (5, f"f\n{words(50)}", ""), (6, words(50, "  ") + "  ", ""), (7, words(50, "  ") + "  ", ""), (8, "long" * 200, ""), (9, "long" * 200, "")]
    got = {r.doc_id: r.text for r in dedup_lines(frame(spark, rows), long=50).collect()}
    assert got == {i: {2: "c\nd", 3: ""}.get(i, t) for i, t, _ in rows}


def test_line_digest(spark):
    """Whole texts gone, line ends, blank lines inside runs, two texts of one id."""
    from postlens.llm.lines import line_digest

    texts = ["A\nB\n", "A\nB\n", "A\nB", "\nA\n  \nB\n\n", "x\nA\nB", "one two three four", "one two three four", "one two three", "one two three",
             "q\none two three four\n", "", None, "\n", "A\nB\nA\nB\nA\nB", "l1\nl2\nl3\nl1\nl2\nl3\nl1\n"]
    rows = [(i, t, "") for i, t in enumerate(texts)] + [(99, "A\nB", ""), (99, "z\nz\nz", ""), (99, "z\nz\nz", "")]
    got = Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in line_digest(frame(spark, rows)).collect())
    want = Counter()
    # rows of one id in the order of Spark's text hash
    from pyspark.sql import functions as F

    marks = {r.text: r.h for r in spark.createDataFrame([(t or "",) for _, t, _ in rows], "text string").select("text", F.hash("text").alias("h")).collect()}
    place = {k: n for n, k in enumerate(sorted({(i, marks[t or ""], t or "") for i, t, _ in rows}))}
    cut = brute_lines([(n, k[2]) for k, n in place.items()])
    for i, t, _ in rows:
        text, gone = cut[place[i, marks[t or ""], t or ""]]
        want[i, (t or "").count("\n") + 1, gone, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert got == want
    assert [g[2] for g in sorted(got) if g[0] in (1, 2, 3)] == [2, 2, 2]


def test_lines_of_one_long_text(spark):
    """Twice the lines, about twice the work."""
    import time

    from postlens.llm.lines import line_digest

    took = []
    for n in (1_000, 20_000, 40_000):
        text = "\n".join(f"line {i} of {n}" if i % 3 else "again and again it comes" for i in range(n))
        df = frame(spark, [(1, text, ""), (2, text, "")])
        start = time.monotonic()
        assert {(r.doc_id, r.n_removed) for r in line_digest(df).collect()} == {(1, n // 3 + (n % 3 > 0) - 1), (2, n)}
        took.append(time.monotonic() - start)
    assert took[2] < 2.5 * took[1], took


def test_line_dedup(spark, edge, none):
    from postlens.llm.lines import dedup_lines, line_digest

    got = dedup_lines(edge)
    assert got.columns == edge.columns and got.count() == len(EDGE)
    want = brute_lines(docs_of(edge))
    for r in got.collect():
        if r.doc_id is not None:
            assert (r.text or "") == want[r.doc_id][0], r.doc_id
    assert [r.text for r in got.filter("doc_id = 11").collect()] == ["zz\nqq"]
    assert got.filter("doc_id = 0").first().text is None
    assert dedup_lines(none).count() == 0 and line_digest(none).count() == 0
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    want = {i: t for i, (t, _) in brute_lines(docs_of(docs), 4, 50).items()}
    assert {r.doc_id: r.text for r in dedup_lines(docs, gram=2, grams=3, long=50).collect()} == want


# ------------------------------------------------------------------ op2
def brute_pii(t):
    pats = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    out = []
    for k, p in enumerate(pats):
        for m in re.finditer(p, t or ""):
            g, d = m.group(), re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(x) > 255 for x in g.split(".")):
                continue
            if k == 2 and not (12 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0):
                continue
            if k == 3 and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii(spark, edge, none):
    from postlens.llm.pii import KINDS, find_pii

    more = ["a@b.c_x@y.z and 1.2.3.4.5.6.7.8 x", "é@x.y q@ü.de u.v+w%@-.-.a @@a@b.c", "256.1.1.1 0001.2.3.4 1.2.3 99999999999.1.1.1",
            "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111111111", "+1 (555) 123-4567+49 30 1234567 +1", "a.b@c.d@e.f",
            "日本 a@b.co 日本 +33 1 23 45 67 89.", "x" * 20_000 + "@a.b", "1" * 20_000, "a@b.c " * 300, "call (212) 555-1234", "bob [at] x [dot] com"]
    df = edge.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(more, 100)), "doc_id long, text string"))
    text = dict(docs_of(df))
    got = find_pii(df).collect()
    assert len(got) == df.count()
    for r in got:
        if r.doc_id is None:
            continue
        spans = brute_pii(text[r.doc_id])
        line = [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in spans) for j in range(4)], r.doc_id
        assert r.base_sha256 == hashlib.sha256(",".join(line).encode()).hexdigest()
        assert set(line) <= set(r.spans.split(",")) | {""}
    assert find_pii(none).count() == 0


def test_pii_positions_and_contexts_of_many_matches(spark):
    from pyspark.sql import functions as F

    from postlens.llm.pii import BASE, NEAR, _fence, before, pieces, starts

    rng = np.random.default_rng(11)
    bits = ["12", "4111 1111 1111 1111", ",", ", ", "é日", "+1 555 123 4567", "a@b.c", "@", " card ", "1.2.3.4", "", "x" * 30]
    texts = ["".join(rng.choice(bits, n)) for n in (0, 1, 5, 40, 700, 700, 3000)] + ["12,34," * 600]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for kind, pattern in BASE.items():
        x = _fence(d, ["doc_id"], p=pieces(F.col("text"), pattern))
        x = _fence(x, ["doc_id", "p"], s=starts(F.col("p")))
        got = x.select("doc_id", F.transform("p", lambda m, i: F.struct(F.get("s", i).alias("at"), m["t"].alias("t"), before(F.col("p"), i).alias("b"))).alias("m")).collect()
        for r in got:
            t = texts[r.doc_id]
            found = [m for m in r.m if m.t is not None]
            assert all(t[m.at:m.at + len(m.t)] == m.t and t[max(0, m.at - NEAR):m.at] == m.b for m in found), kind
            assert all(a.at + len(a.t) <= b.at for a, b in zip(found, found[1:]))
            if r.doc_id == 6:
                assert len(found) > 200  # more than one block, or nearly


def test_pii_loose_spans_give_way_to_base_ones(spark, monkeypatch):
    from postlens.llm import pii

    # all loose candidates are accepted: only the overlap with base spans decides
    monkeypatch.setattr(pii, "train_classifier", lambda cells, post: [100.0] * 200)
    one = "+1 (555) 123-4567 then (212) 555-1234; "
    got = pii.find_pii(spark.createDataFrame([(1, one * 400), (2, "(212) 555-1234")], "doc_id long, text string")).collect()
    spans = {r.doc_id: r.spans.split(",") for r in got}
    want = sorted(x for i in range(400) for x in ((len(one) * i, len(one) * i + 17), (len(one) * i + 23, len(one) * i + 37)))
    assert spans[1] == [f"phone:{a}:{b}" for a, b in want] and spans[2] == ["phone:0:14"]


def test_pii_labelers_outvote_a_broken_one():
    from postlens.llm.pii import _features, reliabilities, train_classifier

    cells = {(2, 1, 1, 1, 2): 60.0, (2, 1, 1, 0, 2): 40.0, (2, 0, 0, 1, 2): 50.0, (2, 0, 0, 0, 2): 50.0, (2, 0, 1, 0, 2): 5.0}
    post = reliabilities(cells)
    assert post[2, 1, 1, 0, 2] > 0.9 and post[2, 0, 0, 1, 2] < 0.1  # the third labeler is a coin
    w = train_classifier(cells, post)
    score = {c: sum(w[i] for i in _features(c)) for c in cells}
    assert score[2, 1, 1, 0, 2] > 2 and score[2, 0, 0, 1, 2] < -2


# ------------------------------------------------------------------ op3
def test_topk(spark):
    from pyspark.sql import functions as F

    from postlens.llm.topk import top_k

    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 4]) for i in range(120)]  # many ties
    rows += [(50, None), (200, [None, 1.0]), (201, [float("nan")]), (202, [float("inf"), 1.0]), (203, []), (204, [0.5]), (None, [1.0]), (7, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS rb", "3 AS v")
    v = {}
    for i, x in rows:
        if i is not None and x is not None and all(e is not None and np.isfinite(e) for e in x):
            ints = [int(np.floor(256 * e)) for e in x]
            v[i] = min(v.get(i, ints), ints)
    want = []
    for q in sorted(v):
        if q % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], v[r])), r) for r in v if r != q)[:5]
            want += [(q, k + 1, r, -s) for k, (s, r) in enumerate(best)]
    got = top_k(df, F.col("vec_id") % 10 == 0, query_block=4, row_block=16)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    assert top_k(df.filter("1 = 0"), F.col("vec_id") % 10 == 0).count() == 0
    assert top_k(df.filter("vec_id = 0"), F.col("vec_id") % 10 == 0).count() == 0  # no other row


# ------------------------------------------------------------------ op4
def brute_hits(docs, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    wins = defaultdict(set)
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[a:a + window])].add("" if i is None else str(i))
    for i, t in docs:
        w, hit, its = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for a in range(len(w) - n + 1):
                if (own := wins.get(tuple(w[a:a + n]))) is not None:
                    hit |= set(range(a, a + n))
                    its |= own
        yield i, len(w), len(hit), len(its), hashlib.sha256(",".join(sorted(its)).encode()).hexdigest(), bool(hit)


def test_decontaminate(spark, edge, none):
    from postlens.llm.decontaminate import contamination, drop_contaminated

    items = [(1, PASSAGE.upper()), (2, "two three"), (2, "FOUR!"), (3, None), (4, ""), (None, "café"), (5, " ".join(f"w{i}" for i in range(100, 115)))]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS len", "2 AS h", "3 AS doc_id")
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = sorted(brute_hits(docs_of(edge), items, 10), key=repr)
    assert rows_of(contamination(edge, bench), *cols) == want
    left = drop_contaminated(edge, bench)
    assert left.columns == edge.columns
    assert sorted(docs_of(left), key=repr) == sorted(((i, t) for (i, t), w in zip(docs_of(edge), brute_hits(docs_of(edge), items, 10)) if not w[-1]), key=repr)
    assert contamination(none, bench).count() == 0 and drop_contaminated(edge, bench.filter("1 = 0")).count() == len(EDGE)
    assert not contamination(edge, bench.filter("1 = 0")).filter("contaminated").count()


def test_decontaminate_in_passes(spark, edge):
    from postlens.llm.decontaminate import find_windows

    bench = spark.createDataFrame([(1, PASSAGE), (2, "two three")], "item_id long, text string")
    one, many = find_windows(edge, bench), find_windows(edge, bench, pass_windows=7)
    assert rows_of(one.distinct(), *one.columns) == rows_of(many.distinct(), *one.columns) != []


# ------------------------------------------------------------------ op5
def brute_seats(votes, seats):
    won = {k: 0 for k in votes}
    heap = [(-v, k) for k, v in votes.items() if v > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, k = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-votes[k] / (2 * won[k] + 1), k))
    return won


def test_sainte_lague(spark):
    from pyspark.sql import functions as F

    from postlens.llm.mixing import sainte_lague

    rng = np.random.default_rng(5)
    for seats in (1, 7, 100, 5000):
        votes = {i: float(x) for i, x in enumerate(rng.integers(1, 1000, 40) * np.where(np.arange(40) == 3, 300, 1))}
        df = spark.createDataFrame([(k, v, seats) for k, v in votes.items()], "k long, votes double, seats long")
        got = {r.k: r.won for r in sainte_lague(df, [], [F.col("k")]).collect()}
        assert got == brute_seats(votes, seats)


def test_mix(spark, edge, none):
    from postlens.llm.mixing import mix

    got = mix(edge)
    rows = got.collect()
    assert len(rows) == len(EDGE) and rows_of(got, *got.columns) == rows_of(mix(edge), *got.columns)
    size = Counter()
    for _, t, s in EDGE:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted(k for k in size if k is not None) + [None]
    weight = dict(zip(names, itertools.cycle((1, 2, 3))))
    total, target, free = sum(size.values()), {}, set(names)
    while True:  # the stated rule, round by round
        rest, w = total - sum(target.values()), sum(weight[k] for k in free)
        over = {k for k in free if rest * weight[k] / w > 3 * size[k]}
        if not over:
            break
        target |= {k: 3.0 * size[k] for k in over}
        free -= over
    target |= {k: rest * weight[k] / w for k in free}
    taken = Counter()
    source = {}
    for i, _, s in EDGE:
        source.setdefault(i, s)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        if r.doc_id is not None:
            assert r.source_size == size[source[r.doc_id]] and abs(r.target - target[source[r.doc_id]]) < 1e-6
            taken[source[r.doc_id]] += r.taken
    for k in ("a", "b", "c"):
        assert abs(taken[k] - target[k]) <= 8
    assert mix(none).count() == 0 and mix(edge.filter("doc_id < 3")).agg({"taken": "sum"}).first()[0] == 0


# ------------------------------------------------------------------ op6, op7
def brute_repeats(parts, window):
    seen = Counter(p[i:i + window] for p in parts for i in range(len(p) - window + 1))
    for p in parts:
        gone = [False] * len(p)
        for i in range(len(p) - window + 1):
            if seen[p[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        yield gone


@pytest.mark.parametrize("crowd", [20_000, 1])
@pytest.mark.parametrize("which", ["edge", "sf"])
def test_substrings(spark, edge, which, crowd):
    from postlens.llm.bwt import dedup_bytes
    from postlens.llm.suffix_tree import dedup_passages

    df = edge if which == "edge" else spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs_of(df)
    raw = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), t, g in zip(rows, raw, brute_repeats(raw, 200)):
        want.append((i, len(t), sum(g), sum(x and (k == 0 or not g[k - 1]) for k, x in enumerate(g)), bytearray(b for b, x in zip(t, g) if not x)))
    got = dedup_bytes(df, crowd=crowd)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == sorted(want, key=repr)
    words = [tuple(t.split()) for t in raw]
    want = [(i, len(w), sum(g), bytearray(b" ".join(x for x, d in zip(w, g) if not d))) for (i, _), w, g in zip(rows, words, brute_repeats(words, 35))]
    got = dedup_passages(df, crowd=crowd)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept") == sorted(want, key=repr)


def test_substrings_of_nothing(none):
    from postlens.llm.bwt import dedup_bytes
    from postlens.llm.suffix_tree import dedup_passages

    assert dedup_bytes(none).count() == 0 and dedup_passages(none).count() == 0


def test_tree_and_bwt_alone():
    from postlens.llm.bwt import repeated_intervals
    from postlens.llm.suffix_tree import deep_nodes

    rng = np.random.default_rng(0)
    for _ in range(150):
        w = int(rng.choice([8, 12, 20]))
        cs = [bytes(rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(w, w + 15))).astype(np.uint8)) for _ in range(int(rng.integers(1, 8)))]
        times = rng.integers(1, 3, len(cs))
        seen = Counter()
        for c, t in zip(cs, times):
            seen.update({c[i:i + w]: 0 for i in range(len(c) - w + 1)})
            for i in range(len(c) - w + 1):
                seen[c[i:i + w]] += int(t)
        want = [[i for i in range(len(c) - w + 1) if seen[c[i:i + w]] > 1] for c in cs]
        assert [x.tolist() for x in repeated_intervals(cs, times, w)] == want
        assert [x.tolist() for x in deep_nodes([b" ".join(bytes([b]) for b in c) for c in cs], times, w)] == want


# ------------------------------------------------------------------ op8
def test_chain_marginals():
    from postlens.llm.quality import marginals

    x, counts, pair = np.random.default_rng(0).normal(size=7), np.array([3, 1, 3]), np.array([[0.5, -1], [0.2, 1.0]])
    good, z, edges = marginals(x, counts, pair, edges=True)
    at, logs = 0, 0.0
    for n in counts:
        s, total, part = x[at:at + n], 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(np.dot(y, s) + sum(pair[a, b] for a, b in zip(y, y[1:])))
            total += w
            part += w * np.array(y)
        assert np.allclose(part / total, good[at:at + n])
        logs, at = logs + np.log(total), at + n
    assert np.isclose(logs, z) and np.isclose(edges.sum(), 4)


def test_quality(spark, edge, none):
    import zlib

    from postlens.llm.quality import keep_good, quality_scores

    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    got = quality_scores(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.97 and held[held.quality == 1].predicted.mean() > 0.98
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    flipped = labels.selectExpr("doc_id", f"if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) AS quality")  # noqa: F541
    again = quality_scores(docs, flipped).toPandas()
    assert (again.sort_values("doc_id").score.to_numpy() == quality_scores(docs, labels).toPandas().sort_values("doc_id").score.to_numpy()).all()
    odd = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1)], "doc_id long, quality int")
    for lab in (labels, odd, labels.filter("1 = 0"), labels.filter("quality = 1")):
        assert quality_scores(edge, lab).count() == len(EDGE) and quality_scores(none, lab).count() == 0
    assert keep_good(edge, labels.filter("1 = 0")).count() == len(EDGE)


# ------------------------------------------------------------------ op9
def brute_fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= bits:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_near_duplicates(spark, edge, none):
    from postlens.llm.simhash import drop_near_duplicates, near_duplicates

    for df in (edge, spark.read.parquet(f"{SF01}/documents.parquet")):
        docs = docs_of(df)
        fps = [brute_fingerprint(t) for _, t in docs]
        comp = brute_components(fps)
        least = {}
        for (i, _), c in zip(docs, comp):
            least[c] = i if least.get(c) is None else least[c] if i is None else min(least[c], i)
        want = sorted(((i, f"{f:016x}", least[c]) for (i, _), f, c in zip(docs, fps, comp)), key=repr)
        assert rows_of(near_duplicates(df), "doc_id", "fingerprint", "component_id") == want
    left = drop_near_duplicates(df)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == sorted(set(least.values()))
    assert near_duplicates(none).count() == 0 and drop_near_duplicates(none).count() == 0
    assert drop_near_duplicates(edge).filter("doc_id = 12").count() == 1


@pytest.mark.parametrize("hot", [200_000, 2])
def test_links_of_planted_fingerprints(spark, hot):
    from postlens.llm.simhash import components, near_links

    rng = np.random.default_rng(1)
    fps = {int(x) for x in rng.integers(-2**63, 2**63 - 1, 200, dtype=np.int64)} | {0, -1, 1, 7, 15}
    for x in list(fps)[:100]:
        for _ in range(6):
            y = x & (2**64 - 1)
            for b in rng.integers(0, 64, int(rng.integers(1, 5))):
                y ^= 1 << int(b)
            fps.add(y - 2**64 if y >> 63 else y)
    fps = sorted(fps)
    roots = brute_components([x & (2**64 - 1) for x in fps])
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.u: r.root for r in components(near_links(df, hot=hot)).collect()}
    assert [got.get(x, x) for x in fps] == [fps[r] for r in roots]


# ------------------------------------------------------------------ op10
def test_langid(spark, edge, none):
    import zlib

    from postlens.llm.langid import identify

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = identify(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()
    lies = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 3 = 1, 'xx', lang) AS lang")
    assert rows_of(identify(lies), "doc_id", "lang_pred") == rows_of(identify(docs), "doc_id", "lang_pred")
    mixed = edge.selectExpr("doc_id", "text", "source AS lang", "1 AS t", "2 AS v")
    for r in identify(mixed).collect():
        if r.doc_id in (0, 1, 2):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert identify(none).count() == 0
    assert {r.lang_pred for r in identify(mixed.withColumn("lang", mixed["lang"].substr(9, 9)).filter("lang is null")).collect()} <= {"und", ""}


def test_bundles_add_up_bound_trigrams():
    from postlens.llm.langid import bundles, letter_vector

    v = [letter_vector(ord(c)) for c in "abc"] + [letter_vector(0)]
    rho = lambda x: np.roll(x, 1)
    gram = lambda a, b, c: rho(rho(v[a]) * v[b]) * v[c]
    want = gram(3, 0, 1).astype(int) + gram(0, 1, 2) + gram(1, 2, 3)
    got = bundles([b"Abc!", b"", b"1 2", b"abc abc"])
    assert (got[0] == want).all() and not got[1].any() and not got[2].any()
    assert (got[3] == 2 * want + gram(2, 3, 0)).all()


# ------------------------------------------------------------------ pipeline
def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet").toPandas().set_index("doc_id")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    ins = docs
    for name, stage in P.STAGES[:-1]:
        out = P.keep(stage(spark, ins, SF001), "test")
        assert out.columns == docs.columns
        before, after = dict(docs_of(ins)), dict(docs_of(out))
        if name == "quality classifier":
            known = labels[labels.index.isin(list(before))]
            assert set(known[known.quality == 1].index) <= set(after)
            assert len(set(known[known.quality == 0].index) & set(after)) <= 2
        elif name == "line dedup":
            assert after == {i: t for i, (t, _) in brute_lines(before.items()).items()}
        elif name == "SimHash near-dedup":
            ids = sorted(before)
            assert set(after) == {ids[r] for r in brute_components([brute_fingerprint(before[i]) for i in ids])}
        else:
            assert set(after) == {i for i, *_, bad in brute_hits(before.items(), bench, 10) if not bad}
        ins = out
    last = P.STAGES[-1][1](spark, ins, SF001)
    assert rows_of(last, *last.columns) == rows_of(P.run(spark, SF001), *last.columns)
    assert P.ORACLE_SQL is None and len(P.STAGES) == 5
