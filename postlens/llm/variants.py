"""Spelling variant grouping: a vocabulary acceptor composed with a one-edit transducer
and with itself."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import crc32_sql, keep, shuffle_partitions, table

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
DAMAGE, LENGTH, TIMES = 97, 5, 3
#: A form is at least this many times as frequent as its variant.
LEAD = 2
#: Words below one initial state; of the packs of partitions that are composed at once.
CROWD, PACK = 20_000, 20_000
HELD, FRONTIER = 200_000, 1 << 19


# ------------------------------------------------------------- words
def damaged_words(docs: DataFrame, damage: int = DAMAGE, length: int = LENGTH, times: int = TIMES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: the runs of all texts, A-Z lower-cased, one code point deleted where
    ``damage`` divides the CRC-32 of ``id:run`` (an id that is null reads as nothing);
    words of ``length`` code points and ``times`` occurrences at least."""
    find = re.compile(RUN).findall

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for b in batches:
            for i, t in zip(b["i"], b["t"]):
                head = zlib.crc32(f"{i}:".encode())
                for run, n in Counter(find(t.lower().decode(errors="replace"))).items():  # bytes: A-Z only
                    h = zlib.crc32(run.encode(), head)
                    if h % damage == 0:
                        run = run[:h % len(run)] + run[h % len(run) + 1:]
                    if len(run) >= length:
                        held[run] += n
                if len(held) > HELD:
                    yield pd.DataFrame(held.items(), columns=["word", "n"])
                    held = Counter()
        if held:
            yield pd.DataFrame(held.items(), columns=["word", "n"])

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.coalesce(text_col, F.lit("")).cast("binary").alias("t"))
    return rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


# ------------------------------------------------------------- acceptors and their composition
class Acceptor:
    """The minimal acyclic acceptor of several sorted word lists, with an initial state
    for each.  Arcs lie in order of state and symbol; an arc's offset says how many
    words of its state come before those below it, so a path ends with the number of
    its word."""

    def __init__(self, lists: list[list[str]]):
        known: dict[tuple, int] = {}
        final, size, arcs = [], [], []

        def freeze(node) -> int:
            sign = (node[0], tuple(node[1]))
            if sign not in known:
                known[sign] = len(final)
                final.append(node[0])
                size.append(node[0] + sum(size[t] for _, t in node[1]))
                arcs.append(sign[1])
            return known[sign]

        self.initial = []
        for words in lists:
            path, last = [[False, []]], ""
            for word in words:
                at = 0
                for a, b in zip(last, word):
                    if a != b:
                        break
                    at += 1
                while len(path) > at + 1:
                    done = freeze(path.pop())
                    path[-1][1].append((ord(last[len(path) - 1]), done))
                for _ in word[at:]:
                    path.append([False, []])
                path[-1][0], last = True, word
            while len(path) > 1:
                done = freeze(path.pop())
                path[-1][1].append((ord(last[len(path) - 1]), done))
            self.initial.append(freeze(path[0]))
        self.final, self.size = np.array(final, bool), np.array(size, np.int64)
        self.degree = np.array([len(a) for a in arcs], np.int64)
        self.first = np.cumsum(self.degree) - self.degree
        flat = np.array([x for a in arcs for x in a], np.int64).reshape(-1, 2)
        self.symbol, self.to = flat[:, 0], flat[:, 1]
        below = np.cumsum(self.size[self.to]) if len(flat) else np.zeros(0, np.int64)
        start = np.repeat(np.append(0, below)[self.first], self.degree)
        self.offset = below - self.size[self.to] - start + np.repeat(self.final, self.degree)
        self.key = np.repeat(np.arange(len(final)), self.degree) << 21 | self.symbol

    def arcs(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every arc that leaves ``states`` the place of its state and its number."""
        d = self.degree[states]
        at = np.repeat(np.arange(len(states)), d)
        return at, np.arange(len(at)) - np.repeat(np.cumsum(d) - d, d) + np.repeat(self.first[states], d)


def compose(a: Acceptor, bases: np.ndarray) -> np.ndarray:
    """Accepted pairs of the composition acceptor, one-edit transducer, acceptor:
    numbers of words, ``bases`` those of each initial state's first.  A state of the
    composition is (state, state, edit used or not); while it is not used the two
    states are one.  A replaced symbol leads along two arcs of a state, an inserted one
    along one arc of one side only; then both sides read alike.  Two sides that meet
    in one state of the minimal acceptor accept the same rest and are done."""
    found = []
    top = int(a.size[a.initial].sum())

    def alike(p, i, q, j):
        work = [(p, i, q, j)]
        while work:
            p, i, q, j = work.pop()
            if len(p) > FRONTIER:
                half = len(p) // 2
                work += [tuple(x[:half] for x in (p, i, q, j)), tuple(x[half:] for x in (p, i, q, j))]
                continue
            met = p == q
            n = a.size[p[met]]
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            u, v = np.repeat(i[met], n) + k, np.repeat(j[met], n) + k
            p, i, q, j = (x[~met] for x in (p, i, q, j))
            both = a.final[p] & a.final[q]
            u, v = np.append(u, i[both]), np.append(v, j[both])
            found.append(np.minimum(u, v) * top + np.maximum(u, v))
            at, arc = a.arcs(p)
            if len(at):
                want = q[at] << 21 | a.symbol[arc]
                other = np.minimum(np.searchsorted(a.key, want), len(a.key) - 1)
                hit = a.key[other] == want
                at, arc, other = at[hit], arc[hit], other[hit]
                if len(at):
                    work.append((a.to[arc], i[at] + a.offset[arc], a.to[other], j[at] + a.offset[other]))

    edited, size = [], 0
    work = [(np.array(a.initial, np.int64), np.asarray(bases, np.int64))]
    while work:
        p, i = work.pop()
        if len(p) > 1 and (a.degree[p] ** 2).sum() > FRONTIER:
            half = len(p) // 2
            work += [(p[:half], i[:half]), (p[half:], i[half:])]
            continue
        at, arc = a.arcs(p)
        if len(at):
            left, two = a.arcs(p[at])
            more = two > arc[left]
            left, two = left[more], two[more]
            edited += [(a.to[arc], i[at] + a.offset[arc], p[at], i[at]),
                       (a.to[arc[left]], i[at[left]] + a.offset[arc[left]], a.to[two], i[at[left]] + a.offset[two])]
            size += len(at) + len(two)
            work.append((a.to[arc], i[at] + a.offset[arc]))
        if edited and (size > FRONTIER or not work):
            alike(*(np.concatenate(x) for x in zip(*edited)))
            edited, size = [], 0
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return np.stack([pairs // max(top, 1), pairs % max(top, 1)])


def _best(words: np.ndarray, n: np.ndarray, pairs: np.ndarray) -> pd.DataFrame:
    """Of each word of ``pairs`` the near words' number and the most frequent one."""
    w, v = np.concatenate([pairs, pairs[::-1]], axis=1)
    names, rank = np.unique(words, return_inverse=True)
    order = np.lexsort((rank[v], -n[v], rank[w]))
    w, v = w[order], v[order]
    head = np.flatnonzero(np.append(True, rank[w][1:] != rank[w][:-1])) if len(w) else np.zeros(0, int)
    return pd.DataFrame({"word": words[w[head]], "n_near": np.diff(np.append(head, len(w))), "best_n": n[v[head]], "best": words[v[head]]})


NEAR = "word string, n_near long, best_n long, best string"


def _composed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole partitions of initial states, some at a time, through the composition."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        words, rest, m = rows["word"].to_numpy(), rows["rest"].tolist(), rows["m"].to_numpy()
        new = _changes(rows)
        ends = np.append(new[1:], len(rows))
        pairs = compose(Acceptor([rest[a:b] for a, b in zip(new, ends)]), new)
        size = np.array([len(w) for w in words])
        u, v = pairs
        pairs = pairs[:, np.minimum(size[u], size[v]) == m[u]]
        # what both readings find is the forward one's
        front = np.array([w[:k // 2] if d else i for i, (w, k, d) in enumerate(zip(words, m, rows["back"]))], object)
        u, v = pairs
        return _best(words, rows["n"].to_numpy(), pairs[:, front[u] != front[v]])

    held = pd.DataFrame()
    for b in batches:
        held = pd.concat([held, b], ignore_index=True) if len(held) else b
        if len(held) > PACK:
            last = _changes(held)[-1]
            if last:
                yield solve(held.iloc[:last])
                held = held.iloc[last:].reset_index(drop=True)
    if len(held):
        yield solve(held)


def _changes(rows: pd.DataFrame) -> np.ndarray:
    """Where partitions begin."""
    m, back, head = (rows[c].to_numpy() for c in ("m", "back", "head"))
    return np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (back[1:] != back[:-1]) | (head[1:] != head[:-1])]))


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """States behind an edit: the words of a group differ in the symbol just read, or
    one of them lacks it; a group is no larger than the alphabet and one."""
    for b in batches:
        out = []
        for words, ns, longer, replaced, m, back in zip(b["words"], b["ns"], b["longer"], b["replaced"], b["m"], b["back"]):
            u, v = np.triu_indices(len(words), 1)
            longer, front = np.asarray(longer, bool), np.array([w[:m // 2] for w in words], object)
            ok = (replaced | (longer[u] != longer[v])) & ((front[u] != front[v]) | (not back))
            out.append(_best(np.array(words, object), np.asarray(ns), np.stack([u[ok], v[ok]])))
        if out:
            yield pd.concat(out, ignore_index=True)


def near_words(words: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """``word, n_near, best_n, best``: of every word of ``words`` (word, n; distinct, of
    ``length`` code points at least) that has near words their number and the most
    frequent one, ties to the smallest.

    Of two words one edit apart, the shorter of m code points, either the first m // 2
    agree or the last m - m // 2.  So the vocabulary is read forwards and backwards and
    the composition is cut into initial states (m, direction, head read so far); a
    word stands below four of them.  Partitions are composed in tasks, a few at a
    time.  Where over ``crowd`` words share a head, the composition takes its next steps
    in Spark: heads grow by 1, 2, 4... symbols, and the states whose edit is one of them
    become groups by the rest still to read.  No pair is dropped."""
    spark = words.sparkSession
    size, m = F.length("word"), F.col("m")
    s = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).filter(m >= length)
    s = s.withColumn("back", F.explode(F.array(F.lit(False), F.lit(True))))
    read, depth = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")), F.when(F.col("back"), m - F.floor(m / 2)).otherwise(F.floor(m / 2)).cast("int")
    s = s.select("word", "n", "m", "back", F.substring(read, F.lit(1), depth).alias("head"), F.substring(read, depth + 1, size).alias("rest"))
    start = ["m", "back", "head"]
    calm, edited, step = [], [], 1
    while True:
        s = keep(s, "variant-states")
        hot = keep(s.groupBy(*start).count().filter(F.col("count") > crowd).select(*start), "variant-crowds")
        calm.append(s.join(hot, start, "left_anti"))
        if hot.isEmpty():
            break
        s = s.join(hot, start, "left_semi")
        left = F.length("rest")
        e = s.withColumn("k", F.explode(F.sequence(F.lit(0), F.least(F.lit(step - 1), left))))
        e = e.withColumn("head", F.concat("head", F.substring("rest", F.lit(1), F.col("k")))).withColumn("rest", F.substring("rest", F.col("k") + 1, size))
        tail, whole = F.substring("rest", F.lit(2), size), size == m
        way = lambda rest, longer, replaced: F.struct(rest.alias("rest"), F.lit(longer).alias("longer"), F.lit(replaced).alias("replaced"))
        # of a run of equal symbols the last one is the one that is lacking
        last = F.substring("rest", 1, 1) != F.substring("rest", 2, 1)
        kept, gone, changed = way(F.col("rest"), False, False), way(tail, True, False), way(tail, False, True)
        ways = F.when(whole & (F.col("rest") == ""), F.array(kept)).when(whole, F.array(kept, changed)).when(~whole & last, F.array(gone))
        e = e.select("word", "n", *start, F.explode(ways).alias("x")).groupBy(*start, "x.rest", "x.replaced")
        edited.append(e.agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("ns"), F.collect_list("x.longer").alias("longer"))
                      .filter(F.size("words") > 1).select("words", "ns", "longer", "replaced", "m", "back"))
        s = s.filter(left >= step).select("word", "n", "m", "back", F.concat("head", F.substring("rest", 1, step)).alias("head"), F.substring("rest", F.lit(step + 1), size).alias("rest"))
        step *= 2
    parts = calm[0]
    for c in calm[1:]:
        parts = parts.unionByName(c)
    near = parts.repartition(shuffle_partitions(spark), *start).sortWithinPartitions(*start, "rest").mapInPandas(_composed, NEAR)
    for e in edited:
        near = near.unionByName(e.mapInPandas(_edited, NEAR))
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def spelling_variants(words: DataFrame, lead: int = LEAD, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (word, n).

    A word's form is its most frequent near word where that is ``lead`` times as
    frequent at least (ties: the smallest in code point order), its root the last of
    the chain of forms.  A chain's frequencies grow by ``lead`` at each step, so it has
    no circle; chains are halved until none moves."""
    near = near_words(words, length, crowd)
    form = F.col("best_n") >= lead * F.col("n")
    w = keep(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form, F.col("best")).alias("form"), F.when(form, F.col("best_n")).alias("form_n")), "variant-forms")
    roots = w.filter("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    while True:
        roots = keep(roots, "variant-roots")
        if roots.filter("moved").isEmpty():
            break
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
    return w.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(keep(damaged_words(table(spark, sf_dir, "documents")), "variant-words"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = f"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
c AS (SELECT run, count(*) AS n, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM r GROUP BY doc_id, run),
e AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM c),
w AS (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= {LENGTH} GROUP BY word HAVING sum(n) >= {TIMES}),
d AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
x AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM d),
p AS (SELECT a.word, b.word AS v, b.n FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
   UNION SELECT x.word, w.word, w.n FROM x JOIN w ON x.less = w.word UNION SELECT w.word, x.word, x.n FROM x JOIN w ON x.less = w.word),
q AS (SELECT word, count(*) AS n_near, min({{'n': -n, 'v': v}}) AS b FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= {LEAD} * w.n THEN b.v END AS form, CASE WHEN -b.n >= {LEAD} * w.n THEN -b.n END AS form_n FROM w LEFT JOIN q USING (word)),
g AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT g.word, f.word, f.form FROM g JOIN f ON g.next = f.word)
SELECT f.word, f.form, g.root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM f JOIN g ON f.word = g.word AND g.next IS NULL
"""
