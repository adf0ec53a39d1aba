"""Learned lexicons and lemmas against plain versions."""

import math
from collections import Counter, defaultdict

from postlens.operators import lexicon as LX

POSTS = [(1, "Vile, VILE words here", 1), (2, "vile things", 1), (3, "vile again, here", 1), (4, "nice words here", 0), (5, "nice day; nice!", 0),
         (6, "a nice walk here", 0), (7, "walks and walks", 0), (8, None, 0), (9, "", 1), (10, "... !!", 0), (11, "vile but unlabelled", None)]


def frames(spark, rows=POSTS):
    posts = spark.createDataFrame(rows, "id long, post string, label int")
    return posts, LX.post_words(posts)


def plain_words(rows):
    out = defaultdict(Counter)
    for i, t, _ in rows:
        for w in (t or "").lower().split():
            w = w.strip(",.;!")
            if w:
                out[i][w] += 1
    return out


def plain_lexicon(rows, prior=10.0, min_posts=2, z_min=0.5):
    words, label = plain_words(rows), {i: y for i, _, y in rows}
    p, q = Counter(), Counter()
    for i, ws in words.items():
        if label[i] is not None:
            for w in ws:
                (p if label[i] else q)[w] += 1
    P, Q, out = sum(p.values()), sum(q.values()), {}
    for w in p | q:
        a = prior * (p[w] + q[w]) / (P + Q)
        d = math.log((p[w] + a) / (P + prior - p[w] - a)) - math.log((q[w] + a) / (Q + prior - q[w] - a))
        z = d / math.sqrt(1 / (p[w] + a) + 1 / (q[w] + a))
        if p[w] + q[w] >= min_posts and abs(z) >= z_min:
            out[w] = max(-4.0, min(4.0, -z))
    return out


def learned(spark, rows=POSTS):
    posts, words = frames(spark, rows)
    return posts, words, LX.induce_lexicon(words, posts, prior=10.0, min_posts=2, z_min=0.5)


def test_words_are_counted_per_post(spark):
    got = {(r.id, r.word): r.n for r in frames(spark)[1].collect()}
    assert got == {(i, w): n for i, ws in plain_words(POSTS).items() for w, n in ws.items()}


def test_lexicon_equals_log_odds_by_hand(spark):
    got = {r.word: r.valence for r in learned(spark)[2].collect()}
    want = plain_lexicon(POSTS)
    assert got.keys() == want.keys() and "vile" in got and got["vile"] < 0 < got["nice"]
    assert all(abs(got[w] - want[w]) < 1e-8 for w in want)


def test_sentiment_equals_its_definition(spark):
    posts, words, lex = learned(spark)
    value, counted = plain_lexicon(POSTS), plain_words(POSTS)
    got = {r.id: r for r in LX.sentiment_stats(posts, words, lex).collect()}
    assert len(got) == len(POSTS)
    for i, _, _ in POSTS:
        ws = list(counted[i].elements())
        v = [value[w] for w in ws if w in value]
        up, down, flat = sum(x + 1 for x in v if x > 0), sum(1 - x for x in v if x < 0), len(ws) - len(v)
        mass = up + down + flat
        want = [sum(v) / math.sqrt(sum(v) ** 2 + 15), up / mass if mass else 0, down / mass if mass else 0, flat / mass if mass else 0,
                sum(v) / len(v) / 4 if v else 0, len(v) / len(ws) if ws else 0]
        assert all(abs(got[i][k] - x) < 1e-8 for k, x in zip(LX.SENTIMENT_NAMES, want)), i


def test_sign_test_counts(spark):
    posts, words, lex = learned(spark)
    labelled = posts.filter("label is not null")
    got = {r.label: (r.n_posts, r.n_signed, r.n_agree) for r in LX.sign_test(LX.sentiment_stats(labelled, words, lex), labelled).collect()}
    assert got[1][0] == 4 and got[0][0] == 6
    assert got[1][1] == got[1][2] == 3  # the three vile posts


def test_full_vector_has_24_statistics(spark):
    posts, words, lex = learned(spark)
    names = LX.full_stat_names()
    assert len(names) == 24 and len(set(names)) == 24
    rows = LX.full_stat_vector(posts, LX.sentiment_stats(posts, words, lex)).collect()
    assert len(rows) == len(POSTS) and all(len(r.stats) == 24 for r in rows)
    of = {r.id: dict(zip(names, r.stats)) for r in rows}
    assert of[1]["n_words"] == 4 and of[1]["compound"] < 0 < of[5]["compound"] and of[10]["repeat_ratio"] > 0


def test_lemmas_are_known_words_at_least_as_frequent(spark):
    rows = [("walk", 5), ("walks", 3), ("walked", 2), ("baked", 1), ("bake", 4), ("bak", 9), ("cities", 1), ("city", 2), ("bus", 8), ("bu", 9),
            ("dogs", 7), ("dog", 6), ("thing", 3), ("likes", 2), ("like", 2), ("lik", 2), ("x9s", 1), ("x9", 4)]
    words = spark.createDataFrame([(1, w, n) for w, n in rows] + [(2, "walk", 1)], "id long, word string, n long")
    got = {r.word: (r.lemma, r.n, r.lemma_n) for r in LX.induce_lemmas(words).collect()}
    assert got == {"walks": ("walk", 3, 6), "walked": ("walk", 2, 6), "baked": ("bak", 1, 9), "cities": ("city", 1, 2), "likes": ("lik", 2, 2)}


def test_empty_tables_and_one_word(spark):
    posts, words = frames(spark, [(1, None, 1)])
    assert LX.induce_lexicon(words, posts).count() == 0 and LX.induce_lemmas(words).count() == 0
    assert LX.sentiment_stats(posts, words, LX.induce_lexicon(words, posts)).collect()[0].compound == 0.0
    posts, words = frames(spark, [(1, "one", 1), (2, "one", 0)])
    assert LX.induce_lexicon(words, posts, min_posts=1, z_min=0.0).count() == 0
