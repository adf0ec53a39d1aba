"""Registered queries, part five: lexicons learned from documents and labels, and
the statistics and lemmas that rest on them."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from postlens.functions import text as TX
from postlens.functions.hashing import md5_bucket
from postlens.operators import hygiene as HY
from postlens.operators import lexicon as LX
from postlens.plans import sqlfrag as S
from postlens.plans.catalog import R6, r6, register
from postlens.sources import table, train_posts

SEED, HELD = 7, 4  # one post in four is held out of the sign test's lexicon


def _words_sql(name: str, posts: str) -> str:
    return f"""{name} AS (SELECT id, word, count(*) AS n FROM (SELECT id, regexp_replace(unnest({S.words_sql('post', lower=True)}), '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g') AS word FROM ({posts}))
WHERE word <> '' GROUP BY id, word)"""


def _lexicon_sql(train: str = "TRUE") -> str:
    """CTEs ``posts``, ``w`` (words of all labelled posts), ``lex`` (learned where ``train``)."""
    z = ("((ln(p + a) - ln(tp + 1000.0 - p - a)) - (ln(q + a) - ln(tq + 1000.0 - q - a))) / sqrt(1.0 / (p + a) + 1.0 / (q + a))")
    return f"""posts AS ({S.POSTS}),
{_words_sql('w', 'SELECT * FROM posts')},
c AS (SELECT word, sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS q FROM w JOIN posts USING (id) WHERE label IN (0, 1) AND {train} GROUP BY word),
t AS (SELECT *, sum(p) OVER () AS tp, sum(q) OVER () AS tq FROM c),
a AS (SELECT *, 1000.0::DOUBLE * (p + q) / (tp + tq) AS a FROM t),
zz AS (SELECT word, p::BIGINT AS n_pos, q::BIGINT AS n_neg, round(({z})::DOUBLE, 9) AS z FROM a WHERE p + q >= 3),
lex AS (SELECT *, greatest(-4.0, least(4.0, -z))::DOUBLE AS valence FROM zz WHERE abs(z) >= 1.96)"""


_SENT_SQL = """g AS (SELECT w.id, sum(n * coalesce(valence, 0.0::DOUBLE)) AS s, sum(CASE WHEN valence > 0 THEN n * (valence + 1.0) ELSE 0.0 END)::DOUBLE AS up,
sum(CASE WHEN valence < 0 THEN n * (1.0 - valence) ELSE 0.0 END)::DOUBLE AS down, sum(CASE WHEN valence IS NULL THEN n ELSE 0 END)::DOUBLE AS flat, sum(n)::DOUBLE AS total
FROM w LEFT JOIN lex ON w.word = lex.word GROUP BY w.id),
sent AS (SELECT p.id, p.label, coalesce(s / sqrt(s * s + 15.0), 0.0)::DOUBLE AS compound, coalesce(up / (up + down + flat), 0.0) AS pos, coalesce(down / (up + down + flat), 0.0) AS neg,
coalesce(flat / (up + down + flat), 0.0) AS neu, CASE WHEN total > flat THEN s / ((total - flat) * 4.0) ELSE 0.0 END::DOUBLE AS polarity, coalesce((total - flat) / total, 0.0) AS subjectivity
FROM posts p LEFT JOIN g ON p.id = g.id)"""


def _learn(spark, sf, held_out: bool = False):
    """Labelled posts, their words and the lexicon, of the posts that are not held out."""
    posts = train_posts(spark, sf)
    words = LX.post_words(posts).persist()
    fit = posts.filter(md5_bucket("id", SEED, HELD) != 0) if held_out else posts
    return posts, words, LX.induce_lexicon(words, fit)


@register("induced_lexicon", f"WITH {_lexicon_sql()} SELECT word, n_pos, n_neg, {R6('z')} AS z, {R6('valence')} AS valence FROM lex")
def q_induced_lexicon(spark, sf):
    return r6(_learn(spark, sf)[2], {"z", "valence"})


@register("induced_sentiment", f"WITH {_lexicon_sql()}, {_SENT_SQL} SELECT id, {', '.join(f'{R6(k)} + 0.0::DOUBLE AS {k}' for k in LX.SENTIMENT_NAMES)} FROM sent")
def q_induced_sentiment(spark, sf):
    posts, words, lex = _learn(spark, sf)
    x = LX.sentiment_stats(posts, words, lex)
    # + 0.0: a sum that cancels to -0.0 is 0.0
    return x.select("id", *[(F.round(k, 6) + F.lit(0.0)).alias(k) for k in LX.SENTIMENT_NAMES])


_HELD = S.md5_bucket_sql("id", SEED, HELD)


@register("lexicon_sign_test", f"""WITH {_lexicon_sql(f'{_HELD} <> 0')}, {_SENT_SQL},
h AS (SELECT label, round(compound, 9) AS c FROM sent WHERE {_HELD} = 0),
k AS (SELECT label, count(*) AS n_posts, count(*) FILTER (c <> 0) AS n_signed, count(*) FILTER ((c < 0 AND label = 1) OR (c > 0 AND label = 0)) AS n_agree FROM h GROUP BY label)
SELECT *, CASE WHEN n_signed > 0 THEN {R6('(2 * n_agree - n_signed) / sqrt(n_signed)')} END AS z FROM k""")
def q_sign_test(spark, sf):
    posts, words, lex = _learn(spark, sf, held_out=True)
    held = posts.filter(md5_bucket("id", SEED, HELD) == 0)
    return r6(LX.sign_test(LX.sentiment_stats(held, words, lex), held), {"z"})


def _full_sql() -> str:
    stats = S.text_stats_sql("post")
    whole = ("n_chars", "n_words", "n_sentences")
    own = ", ".join((R6(stats[k]) if k not in whole else stats[k] + "::DOUBLE") + f" AS {k}" for k in TX.STAT_NAMES if k != "repeat_ratio")
    return f"""WITH {_lexicon_sql()}, {_SENT_SQL}, own AS (SELECT id, {own} FROM posts),
ch AS (SELECT id, post, unnest(range(1, length(post) + 1)) AS i FROM (SELECT id, lower(coalesce(post, '')) AS post FROM posts)),
c2 AS (SELECT id, i, substr(post, i::BIGINT, 1) AS c FROM ch),
isl AS (SELECT id, c, i - row_number() OVER (PARTITION BY id, c ORDER BY i) AS grp FROM c2 WHERE c <> chr(10)),
rc AS (SELECT id, count(*) AS k FROM (SELECT id FROM isl GROUP BY id, c, grp HAVING count(*) >= 3) GROUP BY id)
SELECT own.*, round(coalesce(rc.k, 0) / greatest(n_chars, 1)::DOUBLE, 6) AS repeat_ratio, {', '.join(f'{R6("sent." + k)} + 0.0::DOUBLE AS {k}' for k in LX.SENTIMENT_NAMES)}
FROM own JOIN sent ON own.id = sent.id LEFT JOIN rc ON own.id = rc.id"""


@register("full_stat_vector", _full_sql())
def q_full_stats(spark, sf):
    posts, words, lex = _learn(spark, sf)
    a = vector_to_array("stats")
    v = LX.full_stat_vector(posts, LX.sentiment_stats(posts, words, lex))
    return v.select("id", *[(F.round(a[i], 6) + F.lit(0.0)).alias(k) for i, k in enumerate(LX.full_stat_names())])


_LEMMA_SQL = f"""{_words_sql('dw', 'SELECT doc_id AS id, text AS post FROM documents')},
vocab AS (SELECT word, sum(n)::BIGINT AS n FROM dw GROUP BY word),
rules(suffix, instead) AS (VALUES {', '.join(f"('{s}', '{r}')" for s, r in LX.SUFFIX_RULES)}),
offered AS (SELECT DISTINCT word, n, left(word, length(word) - length(suffix)) || instead AS lemma FROM vocab JOIN rules ON ends_with(word, suffix) AND length(word) >= length(suffix) + 3
WHERE regexp_matches(word, '^\\p{{L}}+$')),
lemmas AS (SELECT o.word, o.lemma, o.n, v.n AS lemma_n FROM offered o JOIN vocab v ON o.lemma = v.word WHERE v.n >= o.n QUALIFY row_number() OVER (PARTITION BY o.word ORDER BY v.n DESC, o.lemma) = 1)"""


def _lemmas(spark, sf):
    # every occurrence a row: words are summed over all posts, so no post's own counts are needed
    return LX.induce_lemmas(LX.word_rows(table(spark, sf, "documents"), "text", "doc_id").select("word", F.lit(1).alias("n")))


@register("induced_lemmas", f"WITH {_LEMMA_SQL} SELECT word, lemma, n, lemma_n FROM lemmas")
def q_induced_lemmas(spark, sf):
    return _lemmas(spark, sf)


@register("induced_lemmatize", f"""WITH {_LEMMA_SQL}, p AS (SELECT id, {S.clean_sql('post')} AS clean FROM ({S.POSTS})),
u AS (SELECT id, unnest({S.words_sql('clean')}) AS word, generate_subscripts({S.words_sql('clean')}, 1) AS pos FROM p),
j AS (SELECT u.id, string_agg(coalesce(lemma, u.word), ' ' ORDER BY pos) AS lemmatized FROM u LEFT JOIN lemmas ON u.word = lemmas.word GROUP BY u.id)
SELECT p.id, md5(coalesce(lemmatized, '')) AS lemmatized_md5, length(coalesce(lemmatized, '')) AS n_chars FROM p LEFT JOIN j ON p.id = j.id""")
def q_induced_lemmatize(spark, sf):
    p = train_posts(spark, sf).select("id", TX.clean_post("post").alias("clean"))
    x = HY.dictionary_lemmatize(p, _lemmas(spark, sf).select("word", "lemma"), "clean")
    return x.select("id", F.md5("lemmatized").alias("lemmatized_md5"), F.length("lemmatized").cast("long").alias("n_chars"))
