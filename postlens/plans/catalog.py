"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame``
per operator, and, where SQL can say it, the DuckDB oracle restating the
same semantics.  Every query reads the given tables (whole), optionally
together with the small edge-row fixture.

Floating outputs are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import text as TX
from postlens.functions.hashing import md5_key
from postlens.operators import eda as EDA
from postlens.operators import features as FE
from postlens.operators import hygiene as HY
from postlens.operators import split as SP
from postlens.plans import flagship as FL
from postlens.plans import sqlfrag as S
from postlens.sources import table, train_posts

QUERIES: dict = {}
ORACLES: dict = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def r6(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def edge_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("post"))
    edges = spark.createDataFrame(S.EDGE_ROWS, "id long, post string")
    return docs.unionByName(edges)


def R6(expr: str) -> str:
    return f"round({expr}, 6)"


# ---------------------------------------------------------------- flagship
def _flagship_sql(tail: str | None = None) -> str:
    p = FL.FLAGSHIP
    sql = f"""
WITH posts AS (SELECT d.doc_id AS id, l.toxic AS label, d.text AS post, d.lang FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT id, label, lang, {S.clean_sql('post')} AS clean, md5(concat(id, ':{p['seed']}')) AS h FROM posts),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, id) - 1 AS rk, count(*) OVER (PARTITION BY label) AS n_c FROM c),
sp AS (SELECT id, label, lang, clean, CASE WHEN rk < floor(n_c * {p['val_frac']}) THEN 'val' ELSE 'train' END AS split FROM r),
toks AS (SELECT id, unnest({S.tokens_sql('clean')}) AS term FROM sp),
counts AS (SELECT id, term, count(*) AS tf FROM toks GROUP BY id, term),
train AS (SELECT id, label FROM sp WHERE split = 'train'),
val AS (SELECT id, label, lang FROM sp WHERE split = 'val'),
tc AS (SELECT * FROM counts WHERE id IN (SELECT id FROM train)),
vs AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tc GROUP BY term HAVING count(*) >= {p['min_df']}),
vocab AS (SELECT term FROM vs ORDER BY cf DESC, term ASC LIMIT {p['max_features']}),
grid AS (SELECT term, g.label FROM vocab, (VALUES (0), (1)) g(label)),
ct AS (SELECT t.label, c.term, sum(c.tf)::DOUBLE AS n_ct FROM tc c JOIN train t ON c.id = t.id JOIN vocab v ON c.term = v.term GROUP BY 1, 2),
cc AS (SELECT g.term, g.label, coalesce(ct.n_ct, 0.0) AS n_ct FROM grid g LEFT JOIN ct ON g.label = ct.label AND g.term = ct.term),
ll AS (SELECT term, label, ln((n_ct + {p['alpha']}) / (sum(n_ct) OVER (PARTITION BY label) + {p['alpha']} * count(*) OVER (PARTITION BY label))) AS logp FROM cc),
pri AS (SELECT label, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS lp FROM train GROUP BY label),
{{TAIL}}vc AS (SELECT * FROM counts WHERE id IN (SELECT id FROM val)),
s AS (SELECT vc.id, sum(CASE WHEN ll.label = 0 THEN vc.tf * ll.logp ELSE 0.0 END) AS c0,
             sum(CASE WHEN ll.label = 1 THEN vc.tf * ll.logp ELSE 0.0 END) AS c1 FROM vc JOIN ll ON vc.term = ll.term GROUP BY vc.id),
scored AS (SELECT v.id, v.label, v.lang,
   round(1.0 / (1.0 + exp(((SELECT lp FROM pri WHERE label = 0) + coalesce(s.c0, 0.0)) - ((SELECT lp FROM pri WHERE label = 1) + coalesce(s.c1, 0.0)))), 9) AS prob
   FROM val v LEFT JOIN s ON v.id = s.id),
pred AS (SELECT *, CASE WHEN prob >= {p['threshold']} THEN 1 ELSE 0 END AS prediction FROM scored),
m AS (SELECT {S.metrics_select_sql(['lang'])} FROM ({S.confusion_sql('pred', ['lang'])})),
a AS ({S.auc_sql('pred', ['lang'])})
SELECT m.lang, m.n, {', '.join(R6('m.' + x) + ' AS ' + x for x in ('accuracy', 'precision', 'recall', 'f1', 'macro_f1'))}, {R6('a.auc')} AS auc
FROM m LEFT JOIN a ON m.lang = a.lang
"""
    if tail is None:
        return sql.replace("{TAIL}", "")
    # the NB model tables only: cut the statement after the prior table
    return sql[:sql.index("{TAIL}")].rstrip().rstrip(",") + "\n" + tail


@register("flagship_nb_by_lang", _flagship_sql())
def q_flagship(spark, sf):
    return FL.flagship(spark, sf)


# ---------------------------------------------------------------- 2.1 sources
@register("load_posts", f"SELECT count(*) AS n, sum(label)::BIGINT AS n_pos, sum(length(post))::BIGINT AS n_chars FROM ({S.POSTS})")
def q_load_posts(spark, sf):
    p = train_posts(spark, sf)
    return p.agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("long").alias("n_pos"),
                 F.sum(F.length("post")).cast("long").alias("n_chars"))


@register("load_feature_matrix",
          "SELECT vec_id AS id, (label < 5)::INT AS label, generate_subscripts(embedding, 1) - 1 AS pos, round(unnest(list_transform(embedding, lambda x: coalesce(CASE WHEN isnan(x) THEN 0.0 ELSE x::DOUBLE END, 0.0))), 6) AS value FROM embeddings")
def q_load_feature_matrix(spark, sf):
    from pyspark.ml.functions import vector_to_array

    from postlens.sources import load_feature_matrix

    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") < 5).cast("int").alias("label"), "embedding")
    m = load_feature_matrix(e, array_col="embedding")
    a = vector_to_array("features")
    m = m.select("id", "label", F.posexplode(a).alias("pos", "value"))
    return m.select("id", "label", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


@register("attach_labels", f"SELECT count(*) AS n, count(DISTINCT d.doc_id) AS n_ids FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def q_attach_labels(spark, sf):
    from postlens.sources import attach_labels

    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "toxic")
    j = attach_labels(d, lab)
    return j.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"))


@register("check_row_alignment", """
SELECT sum(CASE WHEN l.doc_id IS NULL THEN 1 ELSE 0 END)::BIGINT AS only_left,
       sum(CASE WHEN d.doc_id IS NULL THEN 1 ELSE 0 END)::BIGINT AS only_right,
       sum(CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS matched
FROM (SELECT DISTINCT doc_id FROM documents) d FULL OUTER JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""")
def q_check_row_alignment(spark, sf):
    from postlens.sources import check_row_alignment

    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return check_row_alignment(d, lab)


# ---------------------------------------------------------------- 2.2 hygiene
@register("clean_labels", """
SELECT CAST(TRY_CAST(lbl AS DOUBLE) AS INT) AS label, count(*) AS n FROM (
  SELECT CAST(toxic AS VARCHAR) AS lbl FROM labels UNION ALL SELECT * FROM (VALUES ('label'), ('abc'), (NULL), ('1.0'), ('0')) v(lbl)
) WHERE TRY_CAST(lbl AS DOUBLE) IS NOT NULL AND lbl <> 'label' GROUP BY 1""")
def q_clean_labels(spark, sf):
    lab = table(spark, sf, "labels").select(F.col("toxic").cast("string").alias("label"))
    extra = spark.createDataFrame([("label",), ("abc",), (None,), ("1.0",), ("0",)], "label string")
    c = HY.clean_labels(lab.unionByName(extra))
    return c.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@register("fill_or_drop_blank_posts", f"""
SELECT 'fill' AS mode, count(*) AS n, sum(CASE WHEN post = '' THEN 1 ELSE 0 END)::BIGINT AS n_empty FROM (SELECT id, coalesce(post, '') AS post FROM ({S.posts_with_edges_sql()}))
UNION ALL
SELECT 'drop' AS mode, count(*) AS n, 0::BIGINT AS n_empty FROM ({S.posts_with_edges_sql()}) WHERE post IS NOT NULL AND trim(post) <> ''""")
def q_fill_or_drop(spark, sf):
    p = edge_posts(spark, sf)
    f = HY.fill_or_drop_blank_posts(p, "post", "fill")
    d = HY.fill_or_drop_blank_posts(p, "post", "drop")
    a = f.agg(F.lit("fill").alias("mode"), F.count(F.lit(1)).alias("n"),
              F.sum(F.when(F.col("post") == "", 1).otherwise(0)).cast("long").alias("n_empty"))
    b = d.agg(F.lit("drop").alias("mode"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("n_empty"))
    return a.unionByName(b)


@register("rename_drop_columns", "SELECT text AS Text, lang AS Annotation, source FROM documents")
def q_rename_drop(spark, sf):
    d = table(spark, sf, "documents")
    return HY.rename_drop_columns(d, drop=["doc_id", "n_chars"], rename={"text": "Text", "lang": "Annotation"})


@register("count_missing", """
SELECT 'embedding' AS column_name, sum(list_count(list_filter(embedding, lambda x: x IS NULL OR isnan(x))))::BIGINT AS n_missing FROM embeddings
UNION ALL SELECT 'text', sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END)::BIGINT FROM documents""")
def q_count_missing(spark, sf):
    e = HY.count_missing_array(table(spark, sf, "embeddings"), "embedding")
    d = HY.count_missing(table(spark, sf, "documents"), ["text"])
    return e.unionByName(d)


@register("impute_zero", "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR isnan(x) THEN 0.0 ELSE x::DOUBLE END)), 6) AS s FROM embeddings")
def q_impute_zero(spark, sf):
    e = table(spark, sf, "embeddings")
    x = HY.impute_zero(e, "embedding")
    return x.select("vec_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v), 6).alias("s"))


@register("clean_post", f"SELECT id, regexp_replace(regexp_replace({S.clean_sql('post')}, '{S.WS}+', ' ', 'g'), '^ | $', '', 'g') AS clean FROM ({S.posts_with_edges_sql()})")
def q_clean_post(spark, sf):
    p = edge_posts(spark, sf)
    return p.select("id", TX.squeeze_whitespace(TX.clean_post("post")).alias("clean"))


@register("squeeze_whitespace", f"SELECT id, regexp_replace(regexp_replace(coalesce(post, ''), '{S.WS}+', ' ', 'g'), '^ | $', '', 'g') AS squeezed FROM ({S.posts_with_edges_sql()})")
def q_squeeze(spark, sf):
    p = edge_posts(spark, sf)
    return p.select("id", TX.squeeze_whitespace(F.coalesce("post", F.lit(""))).alias("squeezed"))


def _accent_sql(col: str) -> str:
    src, dst = TX._accent_table()
    return f"lower(regexp_replace(translate({col}, {S.q(src)}, {S.q(dst)}), '[^\\x00-\\x7F]', '', 'g'))"


@register("strip_accents_lower", f"SELECT id, {_accent_sql('post')} AS folded FROM ({S.posts_with_edges_sql()}) WHERE post IS NOT NULL")
def q_strip_accents(spark, sf):
    p = edge_posts(spark, sf).filter(F.col("post").isNotNull())
    return p.select("id", TX.strip_accents_lower("post").alias("folded"))


@register("count_symbols", f"SELECT id, {S.count_sub_sql('coalesce(post, \'\')', '#')}::BIGINT AS num_hashtags, {S.count_sub_sql('coalesce(post, \'\')', '@')}::BIGINT AS num_mentions FROM ({S.posts_with_edges_sql()})")
def q_count_symbols(spark, sf):
    return HY.count_symbols(edge_posts(spark, sf), "post")


@register("extract_hashtags", f"SELECT id, array_to_string(regexp_extract_all(coalesce(post, ''), '#[\\p{{L}}\\p{{N}}_]+'), ' ') AS hashtags FROM ({S.posts_with_edges_sql()})")
def q_hashtags(spark, sf):
    p = edge_posts(spark, sf)
    return p.select("id", F.array_join(TX.hashtags("post"), " ").alias("hashtags"))


@register("extract_mentions", f"SELECT id, array_to_string(regexp_extract_all(coalesce(post, ''), '@[\\p{{L}}\\p{{N}}_]+'), ' ') AS mentions FROM ({S.posts_with_edges_sql()})")
def q_mentions(spark, sf):
    p = edge_posts(spark, sf)
    return p.select("id", F.array_join(TX.mentions("post"), " ").alias("mentions"))


@register("sample_rows_per_class", "SELECT lang, doc_id, text FROM (SELECT lang, doc_id, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents) WHERE r = 2")
def q_sample_rows(spark, sf):
    d = table(spark, sf, "documents")
    return HY.sample_rows_per_class(d, "lang", "doc_id", nth=2).select("lang", "doc_id", "text")


def _stats_sql(names):
    st = S.text_stats_sql("post")
    cols = ", ".join((R6(st[n]) if "ratio" in n or "density" in n or "mean" in n else st[n]) + f" AS {n}" for n in names)
    return f"SELECT id, {cols} FROM ({S.posts_with_edges_sql()})"


def _stats_query(names):
    def fn(spark, sf):
        st = TX.text_stat_columns("post")
        p = edge_posts(spark, sf)
        return r6(p.select("id", *[st[n].alias(n) for n in names]),
                  [n for n in names if "ratio" in n or "density" in n or "mean" in n])
    return fn


for _k, _names in {
    "text_stats_basic": ["n_chars", "n_words", "n_sentences"],
    "text_stats_case": ["upper_ratio", "lower_ratio", "caps_word_ratio"],
    "text_stats_punct": ["punct_ratio", "excl_ratio", "quest_ratio", "excl3_ratio", "quest3_ratio"],
    "text_stats_lexicon_hits": ["indicator_ratio"],
    "text_stats_mask_chars": ["mask_ratio"],
    "text_stats_vocab": ["unique_word_ratio", "mean_word_len"],
    "text_stats_social": ["mention_density", "hashtag_density"],
}.items():
    register(_k, _stats_sql(_names))(_stats_query(_names))


def _repeat_sql() -> str:
    # runs of >= 3 equal characters (not newline) in the lower-cased text,
    # found as islands over the character sequence (RE2 has no back-references)
    return f"""
WITH p AS (SELECT id, lower(coalesce(post, '')) AS t FROM ({S.posts_with_edges_sql()})),
ch AS (SELECT id, t, unnest(range(1, length(t) + 1)) AS i FROM p),
c2 AS (SELECT id, i, substr(t, i::BIGINT, 1) AS c FROM ch),
isl AS (SELECT id, c, i - row_number() OVER (PARTITION BY id, c ORDER BY i) AS grp FROM c2 WHERE c <> chr(10)),
runs AS (SELECT id, c, grp, count(*) AS len FROM isl GROUP BY id, c, grp),
rc AS (SELECT id, sum((len // 3 > 0)::INT + 0) AS k FROM runs WHERE len >= 3 GROUP BY id)
SELECT p.id, round(coalesce(rc.k, 0) / greatest(length(p.t), 1)::DOUBLE, 6) AS repeat_ratio FROM p LEFT JOIN rc ON p.id = rc.id"""


@register("text_stats_repeats", _repeat_sql())
def q_repeats(spark, sf):
    st = TX.text_stat_columns("post")
    return edge_posts(spark, sf).select("id", F.round(st["repeat_ratio"], 6).alias("repeat_ratio"))


@register("text_stat_vector", "SELECT id, " + ", ".join(
    (R6(S.text_stats_sql('post')[n]) if n not in ('n_chars', 'n_words', 'n_sentences') else S.text_stats_sql('post')[n] + '::DOUBLE') + f" AS {n}"
    for n in TX.STAT_NAMES if n != "repeat_ratio") + f" FROM ({S.POSTS})")
def q_stat_vector(spark, sf):
    from pyspark.ml.functions import vector_to_array

    names = [n for n in TX.STAT_NAMES if n != "repeat_ratio"]
    v = HY.text_stat_vector(train_posts(spark, sf), "post", names)
    a = vector_to_array("stats")
    return v.select("id", *[F.round(a[i], 6).alias(n) if n not in ("n_chars", "n_words", "n_sentences")
                            else a[i].alias(n) for i, n in enumerate(names)])


def all_queries():
    return QUERIES


def all_oracles():
    return ORACLES


# ---------------------------------------------------------------- 2.3 tokens and text features
def _toks_sql(stop=True):
    return f"SELECT id, label, {S.tokens_sql('post', stop)} AS tokens FROM ({S.POSTS})"


def _toks(spark, sf, stop=True):
    return FE.tokenize_words(train_posts(spark, sf), "post", remove_stop_words=stop)


@register("tokenize_words", f"SELECT id, len(tokens)::BIGINT AS n_tokens, array_to_string(tokens, ' ') AS joined FROM ({_toks_sql()})")
def q_tokenize(spark, sf):
    t = _toks(spark, sf)
    return t.select("id", F.size("tokens").cast("long").alias("n_tokens"), F.array_join("tokens", " ").alias("joined"))


@register("word_ngrams", f"""
SELECT term, count(*) AS cf FROM (
  SELECT unnest(list_transform(range(1, len(tokens) - n + 2), lambda i: array_to_string(tokens[i:i + n - 1], ' '))) AS term
  FROM ({_toks_sql()}), (VALUES (1), (2), (3)) g(n) WHERE len(tokens) >= n)
GROUP BY term""")
def q_word_ngrams(spark, sf):
    return FE.word_ngram_counts(_toks(spark, sf), "tokens", 1, 3)


@register("char_ngrams", f"""
WITH t AS (SELECT id, regexp_replace(lower(coalesce(post, '')), '{S.WS}{{2,}}', ' ', 'g') AS t FROM ({S.POSTS}))
SELECT g AS term, count(*) AS cf FROM (
  SELECT unnest(list_transform(range(1, length(t) - n + 2), lambda i: substr(t, i, n))) AS g FROM t, (VALUES (2), (3), (4), (5), (6)) v(n) WHERE length(t) >= n)
GROUP BY g""")
def q_char_ngrams(spark, sf):
    return FE.char_ngram_counts(train_posts(spark, sf), "post", 2, 6)


def _counts_sql(stop=True):
    return f"SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(tokens) AS term FROM ({_toks_sql(stop)})) GROUP BY id, term"


@register("term_counts", _counts_sql())
def q_term_counts(spark, sf):
    return FE.term_counts(_toks(spark, sf))


@register("binary_counts", f"SELECT id, term, least(tf, 1)::BIGINT AS tf FROM ({_counts_sql()})")
def q_binary_counts(spark, sf):
    return FE.binary_counts(FE.term_counts(_toks(spark, sf)))


VOCAB = dict(min_df=2, max_df=0.95, max_features=3000)


def _vocab_sql():
    return f"""SELECT term, df, cf, (row_number() OVER (ORDER BY cf DESC, term ASC) - 1)::INT AS idx FROM (
  SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM ({_counts_sql()}) GROUP BY term
  HAVING count(*) >= {VOCAB['min_df']} AND count(*) <= floor({VOCAB['max_df']} * (SELECT count(*) FROM ({S.POSTS})))
  ORDER BY cf DESC, term ASC LIMIT {VOCAB['max_features']})"""


def _n_posts(spark, sf):
    """All labelled posts, also those without a token."""
    return train_posts(spark, sf).count()


def _vocab(spark, sf):
    c = FE.term_counts(_toks(spark, sf))
    return c, FE.build_vocabulary(c, n_docs=_n_posts(spark, sf), min_df=VOCAB["min_df"], max_df=VOCAB["max_df"], max_features=VOCAB["max_features"])


@register("build_vocabulary", _vocab_sql())
def q_vocab(spark, sf):
    return _vocab(spark, sf)[1]


def _tfidf_sql(sublinear: bool):
    tf = "(1.0 + ln(c.tf))" if sublinear else "c.tf::DOUBLE"
    return f"""WITH c AS ({_counts_sql()}), v AS ({_vocab_sql()}),
n AS (SELECT count(*) AS n FROM ({S.POSTS})),
x AS (SELECT c.id, c.term, {tf} * (ln((1.0 + n.n) / (1.0 + v.df)) + 1.0) AS w FROM c JOIN v ON c.term = v.term, n)
SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS value FROM x"""


def _tfidf(spark, sf, sublinear):
    c, v = _vocab(spark, sf)
    n = _n_posts(spark, sf)
    t = FE.tfidf(c, v, n, sublinear=sublinear)
    return t.select("id", "term", F.round("value", 6).alias("value"))


@register("tfidf", _tfidf_sql(False))
def q_tfidf(spark, sf):
    return _tfidf(spark, sf, False)


@register("tfidf_sublinear", _tfidf_sql(True))
def q_tfidf_sublinear(spark, sf):
    return _tfidf(spark, sf, True)


@register("hashed_counts")
def q_hashed(spark, sf):
    from pyspark.ml.functions import vector_to_array

    h = FE.hashed_counts(_toks(spark, sf), "tokens", 1 << 10)
    return h.select("id", F.round(F.aggregate(vector_to_array("hashed"), F.lit(0.0), lambda s, x: s + x * x), 6).alias("sq_norm"))


@register("multi_view_features")
def q_multi_view(spark, sf):
    from postlens.plans.views import multi_view_features

    return multi_view_features(spark, sf).select("id", F.col("features").alias("features"))


@register("token_index", f"""SELECT token, count(*) AS freq, row_number() OVER (ORDER BY count(*) DESC, token ASC)::INT AS token_id
FROM (SELECT unnest(tokens) AS token FROM ({_toks_sql(False)})) GROUP BY token""")
def q_token_index(spark, sf):
    return FE.token_index(_toks(spark, sf, stop=False))


@register("pad_sequences", f"""
WITH ti AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token ASC)::INT AS token_id
            FROM (SELECT unnest(tokens) AS token FROM ({_toks_sql(False)})) GROUP BY token),
seq AS (SELECT t.id, list(ti.token_id ORDER BY t.pos) AS s FROM
        (SELECT id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM ({_toks_sql(False)})) t JOIN ti ON t.token = ti.token GROUP BY t.id),
pad AS (SELECT id, CASE WHEN len(s) > 40 THEN s[len(s) - 39:] ELSE s END AS k FROM seq)
SELECT id, array_to_string(list_concat(list_transform(range(greatest(0, 40 - len(k))), lambda i: 0), k), ',') AS padded FROM pad""")
def q_pad(spark, sf):
    t = _toks(spark, sf, stop=False)
    ti = FE.token_index(t)
    seq = (t.select("id", F.posexplode("tokens").alias("pos", "token")).join(ti, "token")
           .groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "token_id"))).alias("_s"))
           .select("id", F.transform("_s", lambda s: s["token_id"]).alias("seq")))
    return seq.select("id", F.array_join(FE.pad_sequences("seq", 40).cast("array<string>"), ",").alias("padded"))


def _word_vectors_sql():
    # derived word vectors: each frequent token gets the embedding row whose
    # vec_id equals its frequency rank (a deterministic stand-in for pretrained vectors)
    return f"""SELECT ti.token AS word, e.embedding AS vec FROM
      (SELECT token, (row_number() OVER (ORDER BY count(*) DESC, token ASC) - 1) AS r FROM (SELECT unnest(tokens) AS token FROM ({_toks_sql()})) GROUP BY token) ti
      JOIN embeddings e ON e.vec_id = ti.r"""


def word_vectors(spark, sf):
    ti = FE.token_index(_toks(spark, sf)).withColumn("r", F.col("token_id") - 1)
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("r"), F.col("embedding").alias("vec"))
    return ti.join(e, "r").select(F.col("token").alias("word"),
                                                                 F.col("vec").cast("array<double>").alias("vec"))


@register("embedding_lookup", f"""WITH v AS ({_vocab_sql()}), wv AS ({_word_vectors_sql()})
SELECT v.term, generate_subscripts(range(64), 1) - 1 AS pos, round(unnest(coalesce(wv.vec::DOUBLE[], list_transform(range(64), lambda i: 0.0::DOUBLE))), 6) AS value,
       CASE WHEN wv.vec IS NULL THEN 0 ELSE 1 END AS known FROM v LEFT JOIN wv ON v.term = wv.word""")
def q_embedding_lookup(spark, sf):
    _, v = _vocab(spark, sf)
    x = FE.embedding_lookup(v.select("term"), word_vectors(spark, sf), 64)
    x = x.select("term", "known", F.posexplode("vec").alias("pos", "value"))
    return x.select("term", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"), "known")


@register("mean_pool_embeddings", f"""WITH c AS ({_counts_sql()}), wv AS ({_word_vectors_sql()}),
j AS (SELECT c.id, c.tf, unnest(wv.vec::DOUBLE[]) AS x, generate_subscripts(wv.vec, 1) AS pos FROM c JOIN wv ON c.term = wv.word)
SELECT id, pos - 1 AS pos, round(sum(x * tf) / sum(tf), 6) AS value FROM j GROUP BY id, pos""")
def q_mean_pool(spark, sf):
    posts = _toks(spark, sf)
    c = FE.term_counts(posts)
    m = FE.mean_pool_embeddings(c, word_vectors(spark, sf), n_docs=posts.count()).select("id", F.posexplode("embedding").alias("pos", "value"))
    return m.select("id", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- 2.9 / 2.10 on the derived scores fixture
from postlens.operators import combine as CB  # noqa: E402
from postlens.operators import evaluate as EV  # noqa: E402
from postlens.plans.fixtures import SCORE_MODELS, TIED_MODEL, scores as fx_scores, scores_sql  # noqa: E402

MODELS = sorted(list(SCORE_MODELS) + [TIED_MODEL])
SC = scores_sql()
VOTES = f"(SELECT id, model, prob, label, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS prediction FROM {SC})"


def _votes(spark, sf):
    return CB.threshold_predict(fx_scores(spark, sf))


@register("threshold_predict", f"SELECT id, model, prediction FROM {VOTES}")
def q_threshold_predict(spark, sf):
    return _votes(spark, sf).select("id", "model", "prediction")


@register("soft_vote", f"SELECT id, round(avg(prob), 6) AS prob, CASE WHEN avg(prob) >= 0.5 THEN 1 ELSE 0 END AS prediction FROM {SC} GROUP BY id")
def q_soft_vote(spark, sf):
    v = CB.soft_vote(fx_scores(spark, sf))
    return v.select("id", F.round("prob", 6).alias("prob"), "prediction")


@register("hard_vote", f"SELECT id, CASE WHEN sum(prediction) * 2 > count(*) THEN 1 ELSE 0 END AS prediction FROM {VOTES} GROUP BY id")
def q_hard_vote(spark, sf):
    return CB.hard_vote(_votes(spark, sf))


@register("quorum_vote", f"SELECT id, CASE WHEN sum(prediction) >= 2 THEN 1 ELSE 0 END AS prediction FROM {VOTES} GROUP BY id")
def q_quorum_vote(spark, sf):
    return CB.quorum_vote(_votes(spark, sf), 2)


_METRICS_SQL = f"SELECT {S.metrics_select_sql(['model'])} FROM ({S.confusion_sql(VOTES, ['model'])})"
_MCOLS = ("accuracy", "precision", "recall", "f1", "f1_0", "weighted_precision", "weighted_recall", "macro_f1", "weighted_f1", "kappa", "mcc")


@register("confusion_matrix", f"SELECT model, label AS actual, prediction AS predicted, count(*) AS n FROM {VOTES} GROUP BY 1, 2, 3")
def q_confusion(spark, sf):
    return EV.confusion_matrix(_votes(spark, sf), ["model"])


@register("binary_metrics", f"""SELECT m.model, m.n, {', '.join(R6('m.' + c) + ' AS ' + c for c in _MCOLS)}, {R6('a.auc')} AS auc
FROM ({_METRICS_SQL}) m LEFT JOIN ({S.auc_sql(VOTES, ['model'])}) a ON m.model = a.model""")
def q_binary_metrics(spark, sf):
    m = EV.binary_metrics(_votes(spark, sf), ["model"])
    return r6(m, set(_MCOLS) | {"auc"})


for _k, _c in {"accuracy": "accuracy", "f1_per_class": "f1", "macro_f1": "macro_f1", "weighted_prf": "weighted_f1",
               "kappa_mcc": "kappa"}.items():
    _cols = [_c] + {"kappa_mcc": ["mcc"], "f1_per_class": ["f1_0"], "weighted_prf": ["weighted_precision", "weighted_recall"]}.get(_k, [])
    register(_k, f"SELECT model, {', '.join(R6(c) + ' AS ' + c for c in _cols)} FROM ({_METRICS_SQL})")(
        (lambda cols: lambda spark, sf: r6(EV.binary_metrics(_votes(spark, sf), ["model"], prob_col=None).select("model", *cols), cols))(_cols))


@register("roc_auc", f"SELECT model, {R6('auc')} AS auc FROM ({S.auc_sql(SC, ['model'])})")
def q_roc_auc(spark, sf):
    from postlens.operators.ranking import auc_by_group

    return r6(auc_by_group(fx_scores(spark, sf), ["model"]), {"auc"})


@register("classification_report", f"""WITH c AS ({S.confusion_sql(VOTES, [])}),
per AS (SELECT '0' AS class, CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS precision, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS recall,
               CASE WHEN tn + 0.5 * (fn + fp) > 0 THEN tn / (tn + 0.5 * (fn + fp)) ELSE 0.0 END AS f1, (tn + fp)::DOUBLE AS support FROM (SELECT tp::DOUBLE tp, fp::DOUBLE fp, fn::DOUBLE fn, tn::DOUBLE tn FROM c)
        UNION ALL
        SELECT '1', CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END,
               CASE WHEN tp + 0.5 * (fp + fn) > 0 THEN tp / (tp + 0.5 * (fp + fn)) ELSE 0.0 END, (tp + fn)::DOUBLE FROM (SELECT tp::DOUBLE tp, fp::DOUBLE fp, fn::DOUBLE fn, tn::DOUBLE tn FROM c)),
allr AS (SELECT * FROM per UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
         UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM per)
SELECT class, {R6('precision')} AS precision, {R6('recall')} AS recall, {R6('f1')} AS f1, support FROM allr""")
def q_class_report(spark, sf):
    r = EV.per_class_report(_votes(spark, sf))
    return r6(r, {"precision", "recall", "f1"})


def _scan_sql(lo, hi, step, metric):
    grid = ", ".join(f"({j}, {k}/100.0)" for j, k in enumerate(range(lo, hi + 1, step)))
    return f"""WITH g AS (SELECT j, t::DOUBLE AS threshold FROM (VALUES {grid}) v(j, t)),
pr AS (SELECT s.model, g.threshold, s.label, CASE WHEN s.prob >= g.threshold THEN 1 ELSE 0 END AS prediction FROM {SC} s, g),
m AS (SELECT {S.metrics_select_sql(['model', 'threshold'])} FROM ({S.confusion_sql('pr', ['model', 'threshold'])})),
r AS (SELECT model, threshold, {metric}, row_number() OVER (PARTITION BY model ORDER BY {metric} DESC, threshold ASC) AS rk FROM m)
SELECT model, round(threshold, 2) AS best_threshold, {R6(metric)} AS best_{metric} FROM r WHERE rk = 1"""


def _scan_q(lo, hi, step, metric):
    def fn(spark, sf):
        s = EV.threshold_scan(fx_scores(spark, sf), EV.threshold_grid(lo, hi, step), group_cols=["model"])
        b = EV.best_threshold(s, metric, group_cols=["model"])
        return b.select("model", F.round("best_threshold", 2).alias("best_threshold"), F.round(f"best_{metric}", 6).alias(f"best_{metric}"))
    return fn


register("threshold_scan_f1", _scan_sql(10, 85, 5, "macro_f1"))(_scan_q(10, 85, 5, "macro_f1"))
register("threshold_scan_accuracy", _scan_sql(10, 90, 1, "accuracy"))(_scan_q(10, 90, 1, "accuracy"))


@register("threshold_counts", f"""SELECT model, t::DOUBLE AS threshold, sum(CASE WHEN prob >= t THEN 1 ELSE 0 END)::BIGINT AS n_pos, sum(CASE WHEN prob >= t THEN 0 ELSE 1 END)::BIGINT AS n_neg
FROM {SC}, (VALUES (0.3), (0.4), (0.5), (0.6), (0.7)) v(t) GROUP BY model, t""")
def q_threshold_counts(spark, sf):
    return _tc(spark, sf)


def _tc(spark, sf):
    from postlens.operators.evaluate import threshold_grid

    sc = fx_scores(spark, sf)
    grid = threshold_grid(30, 70, 10)
    # with every label set to 1, tp / fn at a threshold are the predicted positives / negatives
    s = EV.threshold_scan(sc.withColumn("label", F.lit(1)), grid, group_cols=["model"])
    return s.select("model", F.round("threshold", 2).alias("threshold"),
                    F.round(F.col("recall") * F.col("n")).cast("long").alias("n_pos"),
                    (F.col("n") - F.round(F.col("recall") * F.col("n")).cast("long")).alias("n_neg"))


@register("prediction_distribution", f"SELECT prediction AS predicted, count(*) AS n, {R6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS percent FROM (SELECT id, CASE WHEN avg(prob) >= 0.5 THEN 1 ELSE 0 END AS prediction FROM {SC} GROUP BY id) GROUP BY 1")
def q_pred_dist(spark, sf):
    return r6(EV.prediction_distribution(CB.soft_vote(fx_scores(spark, sf))), {"percent"})


@register("confidence_summary", f"""SELECT {R6('avg(c)')} AS mean_confidence, {R6('median(c)')} AS median_confidence,
 sum(CASE WHEN c > 0.8 THEN 1 ELSE 0 END)::BIGINT AS n_high, sum(CASE WHEN c < 0.6 THEN 1 ELSE 0 END)::BIGINT AS n_low,
 {R6('avg(CASE WHEN c > 0.8 THEN 1.0 ELSE 0.0 END) * 100')} AS pct_high, {R6('avg(CASE WHEN c < 0.6 THEN 1.0 ELSE 0.0 END) * 100')} AS pct_low
FROM (SELECT greatest(avg(prob), 1.0 - avg(prob)) AS c FROM {SC} GROUP BY id)""")
def q_conf_summary(spark, sf):
    c = EV.confidence_summary(CB.soft_vote(fx_scores(spark, sf)))
    return r6(c, {"mean_confidence", "median_confidence", "pct_high", "pct_low"})


@register("log_loss", f"SELECT model, {R6('-avg(label * ln(least(greatest(prob, 1e-15), 1 - 1e-15)) + (1 - label) * ln(1 - least(greatest(prob, 1e-15), 1 - 1e-15)))')} AS log_loss FROM {SC} GROUP BY model")
def q_log_loss(spark, sf):
    sc = fx_scores(spark, sf)
    p = F.least(F.greatest(F.col("prob"), F.lit(1e-15)), F.lit(1 - 1e-15))
    y = F.col("label").cast("double")
    return sc.groupBy("model").agg(F.round(-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p)), 6).alias("log_loss"))


_MF = ["model_disagreement", "confidence_gap", "prediction_variance", "mean_prediction", "median_prediction", "prediction_range"]


@register("meta_features", f"""SELECT id, {', '.join(f"{R6(f'max(CASE WHEN model = {S.q(m)} THEN prob END)')} AS {m}_pred" for m in MODELS)},
 {R6('stddev_pop(prob)')} AS model_disagreement, {R6('max(prob) - min(prob)')} AS confidence_gap, {R6('var_pop(prob)')} AS prediction_variance,
 {R6('avg(prob)')} AS mean_prediction, {R6('median(prob)')} AS median_prediction, {R6('max(prob) - min(prob)')} AS prediction_range,
 sum(CASE WHEN prob > 0.5 THEN 1 ELSE 0 END)::BIGINT AS models_above_threshold FROM {SC} GROUP BY id""")
def q_meta(spark, sf):
    m = CB.meta_features(fx_scores(spark, sf), MODELS)
    return r6(m, set(_MF) | {f"{x}_pred" for x in MODELS})


@register("f1_weights", f"SELECT model, {R6('f1 / sum(f1) OVER ()')} AS weight FROM ({_METRICS_SQL})")
def q_f1_weights(spark, sf):
    m = EV.binary_metrics(_votes(spark, sf), ["model"], prob_col=None)
    return r6(CB.f1_weights(m), {"weight"})


@register("weighted_average", f"""WITH w AS (SELECT model, f1 / sum(f1) OVER () AS weight FROM ({_METRICS_SQL}))
SELECT s.id, {R6('sum(w.weight * s.prob)')} AS prob, CASE WHEN sum(w.weight * s.prob) > 0.5 THEN 1 ELSE 0 END AS prediction FROM {SC} s JOIN w ON s.model = w.model GROUP BY s.id""")
def q_weighted_average(spark, sf):
    m = EV.binary_metrics(_votes(spark, sf), ["model"], prob_col=None)
    x = CB.weighted_average(fx_scores(spark, sf), CB.f1_weights(m))
    return x.select("id", F.round("prob", 6).alias("prob"), "prediction")


@register("agreement_matrix", f"""SELECT a.model AS model_a, b.model AS model_b, {R6('avg(CASE WHEN a.prediction = b.prediction THEN 1.0 ELSE 0.0 END)')} AS agreement
FROM {VOTES} a JOIN {VOTES} b ON a.id = b.id GROUP BY 1, 2""")
def q_agreement(spark, sf):
    return r6(CB.agreement_matrix(_votes(spark, sf), MODELS), {"agreement"})


@register("agreement_summary", f"""SELECT {R6('avg(ag)')} AS mean_agreement, {R6('stddev_pop(ag)')} AS std_agreement FROM (
SELECT a.model AS ma, b.model AS mb, avg(CASE WHEN a.prediction = b.prediction THEN 1.0 ELSE 0.0 END) AS ag
FROM {VOTES} a JOIN {VOTES} b ON a.id = b.id WHERE a.model < b.model GROUP BY 1, 2)""")
def q_agreement_summary(spark, sf):
    return r6(CB.agreement_summary(CB.agreement_matrix(_votes(spark, sf), MODELS)), {"mean_agreement", "std_agreement"})


_CORR_MODELS = sorted(SCORE_MODELS)


@register("prediction_correlation", f"""SELECT a.model AS model_a, b.model AS model_b, {R6('corr(a.prob, b.prob)')} AS correlation
FROM {SC} a JOIN {SC} b ON a.id = b.id WHERE a.model < b.model AND a.model <> '{TIED_MODEL}' AND b.model <> '{TIED_MODEL}' GROUP BY 1, 2""")
def q_corr(spark, sf):
    return r6(CB.prediction_correlation(fx_scores(spark, sf), _CORR_MODELS), {"correlation"})


@register("disagreement_rows", f"""SELECT sum(CASE WHEN a.prediction <> b.prediction THEN 1 ELSE 0 END)::BIGINT AS n_disagree
FROM {VOTES} a JOIN {VOTES} b ON a.id = b.id WHERE a.model = 'm_len' AND b.model = 'm_upper'""")
def q_disagree(spark, sf):
    return CB.disagreement_rows(_votes(spark, sf), "m_len", "m_upper")


@register("estimator_variance", f"SELECT id, {R6('var_pop(prediction::DOUBLE)')} AS variance FROM {VOTES} GROUP BY id")
def q_est_var(spark, sf):
    return r6(CB.estimator_variance(_votes(spark, sf)), {"variance"})


@register("consensus_analysis", f"""WITH f AS (SELECT id, prediction AS first FROM {VOTES} WHERE model = '{MODELS[0]}')
SELECT v.id, {R6('avg(v.prediction)')} AS consensus_ratio, sum(CASE WHEN v.prediction = f.first THEN 1 ELSE 0 END)::BIGINT AS agreement_count,
 {R6('1.0 - sum(CASE WHEN v.prediction = f.first THEN 1 ELSE 0 END) / count(*)')} AS disagreement_ratio FROM {VOTES} v JOIN f ON v.id = f.id GROUP BY v.id""")
def q_consensus(spark, sf):
    return r6(CB.consensus_analysis(_votes(spark, sf), MODELS[0]), {"consensus_ratio", "disagreement_ratio"})


@register("minmax_scores", f"""SELECT s.id, s.model, {R6('CASE WHEN m.mx > m.mn THEN (s.prob - m.mn) / (m.mx - m.mn) ELSE 0.0 END')} AS prob
FROM {SC} s JOIN (SELECT model, min(prob) AS mn, max(prob) AS mx FROM {SC} GROUP BY model) m ON s.model = m.model""")
def q_minmax(spark, sf):
    return r6(CB.minmax_scores(fx_scores(spark, sf)).select("id", "model", "prob"), {"prob"})


@register("vector_stats", f"""SELECT model, {R6('avg(prob)')} AS mean, {R6('stddev_pop(prob)')} AS std, {R6('median(prob)')} AS median,
 {R6('min(prob)')} AS min, {R6('max(prob)')} AS max, {R6('sum(abs(prob))')} AS l1, {R6('sqrt(sum(prob * prob))')} AS l2 FROM {SC} GROUP BY model""")
def q_vector_stats(spark, sf):
    return r6(EDA.vector_stats(fx_scores(spark, sf), "prob", ["model"]), {"mean", "std", "median", "min", "max", "l1", "l2"})


# ---------------------------------------------------------------- 2.4 EDA
_LAB = "(SELECT d.doc_id AS id, d.lang, d.source, d.text AS post, l.toxic AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


def _lab(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", "source", F.col("text").alias("post"))
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    return d.join(lab, "id")


@register("class_distribution", f"SELECT label, count(*) AS n, {R6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS percent FROM {_LAB} GROUP BY label")
def q_class_dist(spark, sf):
    return r6(EDA.class_distribution(_lab(spark, sf)), {"percent"})


@register("category_distribution", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def q_cat_dist(spark, sf):
    return EDA.category_distribution(table(spark, sf, "documents"), "lang")


@register("positives_by_category", f"SELECT lang, sum(label)::BIGINT AS n_pos FROM {_LAB} GROUP BY lang")
def q_pos_by_cat(spark, sf):
    return EDA.positives_by_category(_lab(spark, sf), "lang")


@register("distinct_count", "SELECT count(DISTINCT source) AS n_distinct FROM documents")
def q_distinct(spark, sf):
    return EDA.distinct_count(table(spark, sf, "documents"), "source")


@register("symbol_histogram", " UNION ALL ".join(f"SELECT '{c}' AS symbol, {S.count_sub_sql('coalesce(post, chr(0))', c)}::BIGINT AS value, count(*) AS n FROM ({S.posts_with_edges_sql()}) GROUP BY 2" for c in "#@"))
def q_symbol_hist(spark, sf):
    c = HY.count_symbols(edge_posts(spark, sf), "post")
    both = [EDA.symbol_histogram(c, n).select(F.lit(s).alias("symbol"), "value", "n") for s, n in (("#", "num_hashtags"), ("@", "num_mentions"))]
    return both[0].unionByName(both[1])


@register("crosstab_percent", f"SELECT lang, {R6('avg(CASE WHEN label = 0 THEN 100.0 ELSE 0.0 END)')} AS pct_0, {R6('avg(CASE WHEN label = 1 THEN 100.0 ELSE 0.0 END)')} AS pct_1 FROM {_LAB} GROUP BY lang")
def q_crosstab(spark, sf):
    return r6(EDA.crosstab_percent(_lab(spark, sf), "lang"), {"pct_0", "pct_1"})


def _tags_sql(col: str, sym: str) -> str:
    return f"regexp_extract_all(coalesce({col}, ''), '{sym}[\\p{{L}}\\p{{N}}_]+')"


_TAG_KINDS = {"#": TX.hashtags, "@": TX.mentions}


@register("top_tags", " UNION ALL ".join(f"""SELECT * FROM (SELECT '{s}' AS symbol, tag, count(*) AS n FROM (SELECT unnest({_tags_sql('post', s)}) AS tag FROM ({S.posts_with_edges_sql()}))
GROUP BY tag ORDER BY n DESC, tag ASC LIMIT 10)""" for s in _TAG_KINDS))
def q_top_tags(spark, sf):
    parts = [EDA.top_tags(edge_posts(spark, sf).select(f("post").alias("tags")), "tags", 10).select(F.lit(s).alias("symbol"), "tag", "n")
             for s, f in _TAG_KINDS.items()]
    return parts[0].unionByName(parts[1])


@register("top_tags_by_category", f"""SELECT symbol, lang, tag, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY symbol, lang ORDER BY n DESC, tag ASC) AS rank FROM (
  SELECT symbol, lang, tag, count(*) AS n FROM ({' UNION ALL '.join(f"SELECT '{s}' AS symbol, lang, unnest({_tags_sql('text', s)}) AS tag FROM documents" for s in _TAG_KINDS)}) GROUP BY 1, 2, 3)) WHERE rank <= 10""")
def q_top_tags_cat(spark, sf):
    parts = []
    for s, f in _TAG_KINDS.items():
        d = table(spark, sf, "documents").select("lang", f("text").alias("tags"))
        parts.append(EDA.top_tags_by_category(d, "tags", "lang", 10).select(F.lit(s).alias("symbol"), "lang", "tag", "n", F.col("rank").cast("long").alias("rank")))
    return parts[0].unionByName(parts[1])


@register("top_words_by_class", f"""SELECT label, word, n, rank FROM (SELECT label, word, n, row_number() OVER (PARTITION BY label ORDER BY n DESC, word ASC) AS rank FROM (
  SELECT label, word, count(*) AS n FROM (SELECT label, unnest({S.tokens_sql(S.clean_sql('post'))}) AS word FROM ({S.POSTS})) GROUP BY 1, 2)) WHERE rank <= 20""")
def q_top_words(spark, sf):
    p = FE.tokenize_words(train_posts(spark, sf).withColumn("clean", TX.clean_post("post")), "clean")
    return EDA.top_words_by_class(p, "tokens", "label", 20).select("label", "word", "n", F.col("rank").cast("long").alias("rank"))


@register("class_feature_means", f"""SELECT label, pos, {R6('avg(v)')} AS mean FROM (
  SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY 1, 2""")
def q_class_means(spark, sf):
    e = table(spark, sf, "embeddings")
    m = EDA.class_feature_means(e, "embedding", "label")
    return r6(m.select("label", F.col("pos").cast("long").alias("pos"), "mean"), {"mean"})


# ---------------------------------------------------------------- 2.5 splits, folds, resampling, weights
def _rank_sql(seed, extra=""):
    return (f"SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat(id, ':{seed}')), id) - 1 AS rk, "
            f"count(*) OVER (PARTITION BY label) AS n_c{extra} FROM ({S.POSTS})")


def _posts_lab(spark, sf):
    return train_posts(spark, sf).select("id", "label")


@register("train_val_split", f"SELECT CASE WHEN {S.md5_uniform_sql('id', 7) if hasattr(S, 'md5_uniform_sql') else ''} < 0.2 THEN 'val' ELSE 'train' END AS split, count(*) AS n FROM ({S.POSTS}) GROUP BY 1"
          .replace(" if hasattr(S, 'md5_uniform_sql') else ''", ""))
def q_tv_split(spark, sf):
    return SP.train_val_split(_posts_lab(spark, sf), 0.2, 7).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_split", f"SELECT id, label, CASE WHEN rk < floor(n_c * 0.15) THEN 'val' ELSE 'train' END AS split FROM ({_rank_sql(42)})")
def q_strat_split(spark, sf):
    return SP.stratified_split(_posts_lab(spark, sf), 0.15, 42).select("id", "label", "split")


@register("kfold", f"SELECT id, {S.md5_bucket_sql('id', 42, 5)}::INT AS fold FROM ({S.POSTS})")
def q_kfold(spark, sf):
    return SP.kfold(_posts_lab(spark, sf), 5, 42).select("id", "fold")


@register("stratified_kfold", f"SELECT id, label, (rk % 5)::INT AS fold FROM ({_rank_sql(42)})")
def q_strat_kfold(spark, sf):
    return SP.stratified_kfold(_posts_lab(spark, sf), 5, 42).select("id", "label", "fold")


@register("group_kfold", f"SELECT source, {S.md5_bucket_sql('source', 42, 5)}::INT AS fold, count(*) AS n FROM documents GROUP BY 1, 2")
def q_group_kfold(spark, sf):
    d = table(spark, sf, "documents")
    return SP.group_kfold(d, "source", 5, 42).groupBy("source", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_subsample", f"SELECT id, label FROM ({_rank_sql(42)}) WHERE rk < floor(100.0 * n_c / (SELECT count(*) FROM ({S.POSTS})))")
def q_strat_sub(spark, sf):
    return SP.stratified_subsample(_posts_lab(spark, sf), 100, 42).select("id", "label")


@register("random_subsample_n", f"SELECT id FROM ({S.POSTS}) ORDER BY md5(concat(id, ':42')), id LIMIT 50")
def q_rand_sub(spark, sf):
    return SP.random_subsample_n(_posts_lab(spark, sf), 50, 42).select("id")


def _poisson_sql(u: str) -> str:
    import math

    cdf, acc, p = [], 0.0, math.exp(-1.0)
    for k in range(8):
        acc += p
        cdf.append(acc)
        p = p / (k + 1)
    return "CASE " + " ".join(f"WHEN {u} < {repr(c)} THEN {k}" for k, c in enumerate(cdf)) + " ELSE 8 END"


_BAGS_SQL = f"""SELECT id, label, bag, ({_poisson_sql(S.md5_uniform_sql("concat(id, '/', bag)", 42))})::INT AS weight
FROM ({S.POSTS}), (SELECT unnest(range(0, 5)) AS bag)"""


@register("bootstrap_bags", f"SELECT bag::INT AS bag, sum(weight)::BIGINT AS n_drawn, sum(CASE WHEN weight > 0 THEN 1 ELSE 0 END)::BIGINT AS n_distinct FROM ({_BAGS_SQL}) GROUP BY bag")
def q_bags(spark, sf):
    b = SP.bootstrap_bags(_posts_lab(spark, sf), 5, 42)
    return b.groupBy("bag").agg(F.sum("weight").cast("long").alias("n_drawn"),
                                F.sum((F.col("weight") > 0).cast("int")).cast("long").alias("n_distinct"))


@register("out_of_bag", f"SELECT id, bag::INT AS bag FROM ({_BAGS_SQL}) WHERE weight = 0")
def q_oob(spark, sf):
    return SP.out_of_bag(SP.bootstrap_bags(_posts_lab(spark, sf), 5, 42)).select("id", "bag")


@register("random_oversample", f"""WITH r AS ({_rank_sql(42)}), m AS (SELECT max(n_c) AS mx FROM r),
c AS (SELECT r.id, r.label, floor(m.mx / r.n_c) + CASE WHEN r.rk < m.mx - floor(m.mx / r.n_c) * r.n_c THEN 1 ELSE 0 END AS copies FROM r, m)
SELECT label, sum(copies)::BIGINT AS n, count(*) AS n_distinct FROM c GROUP BY label""")
def q_oversample(spark, sf):
    o = SP.random_oversample(_posts_lab(spark, sf))
    return o.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_distinct"))


@register("class_weights_balanced", f"SELECT label, {R6('sum(count(*)) OVER () / (2.0 * count(*))')} AS class_weight FROM ({S.POSTS}) GROUP BY label")
def q_cw(spark, sf):
    return r6(SP.class_weights_balanced(_posts_lab(spark, sf)), {"class_weight"})


@register("sample_weights", f"""WITH w AS (SELECT label, sum(count(*)) OVER () / (2.0 * count(*)) AS w FROM ({S.POSTS}) GROUP BY label)
SELECT p.label, {R6('sum(w.w)')} AS total_weight FROM ({S.POSTS}) p JOIN w ON p.label = w.label GROUP BY p.label""")
def q_sw(spark, sf):
    w = SP.sample_weights(_posts_lab(spark, sf), "balanced")
    return r6(w.groupBy("label").agg(F.sum("weight").alias("total_weight")), {"total_weight"})


@register("positive_weight", f"SELECT label, {R6('sum(CASE WHEN label = 1 THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END)')} AS total_weight FROM ({S.POSTS}) GROUP BY label")
def q_pw(spark, sf):
    w = SP.positive_weight(_posts_lab(spark, sf), 3.0)
    return r6(w.groupBy("label").agg(F.sum("weight").alias("total_weight")), {"total_weight"})


# ---------------------------------------------------------------- 2.6 / 2.7 models (rows-only checks)
from postlens.operators.models import knn as KNN  # noqa: E402
from postlens.operators.models import linear as LIN  # noqa: E402
from postlens.operators.models import nb as NB  # noqa: E402


def dense_split(spark, sf, seed: int = 42):
    """embeddings as a binary task: x = 64 floats, label = class < 5,
    20 % test by md5 of the id."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"),
                                              (F.col("label") < 5).cast("int").alias("label"))
    e = SP.train_val_split(e, 0.2, seed)
    return e.filter(F.col("split") == "train").drop("split"), e.filter(F.col("split") == "val").drop("split")


def _vec(df):
    from pyspark.ml.functions import array_to_vector

    return df.withColumn("features", array_to_vector("x"))


def _mllib_query(make):
    def fn(spark, sf):
        tr, te = dense_split(spark, sf)
        n = tr.count()
        model = make(n).fit(_vec(tr))
        out = model.transform(_vec(te))
        if "probability" in out.columns:
            out = LIN.positive_prob(out)
        else:
            out = out.withColumn("prob", F.lit(None).cast("double"))
        return out.select("id", "label", F.col("prediction").cast("int").alias("prediction"), F.round("prob", 6).alias("prob"))
    return fn


register("logistic_regression")(_mllib_query(lambda n: LIN.logistic_regression(C=1.0, n=n)))
register("lasso_logistic")(_mllib_query(lambda n: LIN.logistic_regression(C=1.0, n=n, l1_ratio=1.0)))
register("elastic_net_logistic")(_mllib_query(lambda n: LIN.logistic_regression(C=1.0, n=n, l1_ratio=0.5)))
register("linear_svc")(_mllib_query(lambda n: LIN.linear_svc(C=1.0, n=n)))
register("decision_tree")(_mllib_query(lambda n: LIN.decision_tree(max_depth=5)))
register("random_forest")(_mllib_query(lambda n: LIN.random_forest(n_trees=50, max_depth=8)))


@register("ridge_classifier")
def q_ridge(spark, sf):
    tr, te = dense_split(spark, sf)
    m = LIN.ridge_classifier(_vec(tr))
    out = m.transform(_vec(te))
    return out.select("id", "label", (F.col("prediction") > 0).cast("int").alias("prediction"))


@register("gd_logistic")
def q_gd_logistic(spark, sf):
    tr, te = dense_split(spark, sf)
    w, b, hist = LIN.gd_logistic(tr, 64, epochs=1000, lr=0.01, batch=64)
    s = LIN.score_linear(te, w, b)
    return s.select("id", "label", (F.col("prob") >= 0.5).cast("int").alias("prediction"), F.round("prob", 6).alias("prob"))


_DENSE_SQL = f"(SELECT vec_id AS id, embedding::DOUBLE[] AS x, (label < 5)::INT AS label, {S.md5_uniform_sql('vec_id', 42)} < 0.2 AS test FROM embeddings)"

_GAUSSIAN_SQL = f"""WITH d AS {_DENSE_SQL},
e AS (SELECT id, label, test, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM d),
mx AS (SELECT max(fv) AS mx FROM (SELECT var_pop(v) AS fv FROM e WHERE NOT test GROUP BY pos)),
m AS (SELECT label, pos, avg(v) AS mu, var_pop(v) + 1e-9 * any_value(mx) AS var FROM e, mx WHERE NOT test GROUP BY label, pos),
pri AS (SELECT label, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS lp FROM d WHERE NOT test GROUP BY label),
s AS (SELECT e.id, m.label AS c, sum(-0.5 * ln(2 * 3.141592653589793 * m.var) - (e.v - m.mu) * (e.v - m.mu) / (2 * m.var)) AS ll FROM e JOIN m ON e.pos = m.pos WHERE e.test GROUP BY 1, 2),
w AS (SELECT s.id, sum(CASE WHEN s.c = 0 THEN s.ll + lp END) AS s0, sum(CASE WHEN s.c = 1 THEN s.ll + lp END) AS s1 FROM s JOIN pri ON s.c = pri.label GROUP BY s.id)
SELECT d.id, d.label, (1.0 / (1.0 + exp(s0 - s1)) >= 0.5)::INT AS prediction FROM d JOIN w ON d.id = w.id"""


@register("gaussian_nb", _GAUSSIAN_SQL)
def q_gaussian_nb(spark, sf):
    tr, te = dense_split(spark, sf)
    m = NB.fit_gaussian_nb(tr)
    s = NB.score_gaussian_nb(m, te)
    return te.select("id", "label").join(s, "id").select("id", "label", (F.col("prob") >= 0.5).cast("int").alias("prediction"))


_KNN_SQL = f"""WITH d AS {_DENSE_SQL},
n AS (SELECT q.id, t.id AS nid, t.label, sqrt(list_sum(list_transform(list_zip(q.x, t.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS distance FROM d q JOIN d t ON q.test AND NOT t.test),
k AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(distance, 12), nid) <= 5)
SELECT id, (avg(label) > 0.5)::INT AS prediction, avg(label)::DOUBLE AS prob FROM k GROUP BY id"""


@register("knn_classify", _KNN_SQL)
def q_knn(spark, sf):
    tr, te = dense_split(spark, sf)
    nb = KNN.nearest_neighbors(tr, te, k=5, p=2)
    return KNN.knn_classify(nb)


def _nb_sql(kind: str) -> str:
    """The NB family on the training posts' 2,000 most frequent tokens, alpha 1."""
    tf = "1" if kind == "bernoulli" else "tf"
    weight = {
        "multinomial": "SELECT term, label, ln((n_ct + 1.0) / (sum(n_ct) OVER (PARTITION BY label) + count(*) OVER (PARTITION BY label))) AS w, 0.0 AS absent FROM cc",
        "complement": "SELECT term, label, -ln((rest + 1.0) / (sum(rest) OVER (PARTITION BY label) + count(*) OVER (PARTITION BY label))) AS w, 0.0 AS absent FROM (SELECT *, sum(n_ct) OVER (PARTITION BY term) - n_ct AS rest FROM cc)",
        "bernoulli": "SELECT term, label, ln(p) - ln(1 - p) AS w, ln(1 - p) AS absent FROM (SELECT cc.*, (n_ct + 1.0) / (n + 2.0) AS p FROM cc JOIN nc ON cc.label = nc.label)",
    }[kind]
    prior = "0.0" if kind == "complement" else "ln(n / sum(n) OVER ())"
    return f"""
WITH c AS (SELECT d.doc_id AS id, l.toxic AS label, {S.clean_sql('d.text')} AS clean, md5(concat(d.doc_id, ':42')) AS h FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
sp AS (SELECT id, label, clean, row_number() OVER (PARTITION BY label ORDER BY h, id) - 1 < floor(count(*) OVER (PARTITION BY label) * 0.2) AS val FROM c),
counts AS (SELECT id, label, val, term, count(*) AS tf FROM (SELECT id, label, val, unnest({S.tokens_sql('clean')}) AS term FROM sp) GROUP BY ALL),
vocab AS (SELECT term FROM counts WHERE NOT val GROUP BY term HAVING count(*) >= 2 ORDER BY sum(tf) DESC, term LIMIT 2000),
nc AS (SELECT label, count(*)::DOUBLE AS n FROM sp WHERE NOT val GROUP BY label),
ct AS (SELECT label, term, sum({tf})::DOUBLE AS n_ct FROM counts WHERE NOT val GROUP BY label, term),
cc AS (SELECT v.term, g.label, coalesce(ct.n_ct, 0.0) AS n_ct FROM vocab v CROSS JOIN (VALUES (0), (1)) g(label) LEFT JOIN ct ON ct.label = g.label AND ct.term = v.term),
ll AS ({weight}),
pri AS (SELECT label, lp + (SELECT sum(absent) FROM ll WHERE ll.label = p.label) AS lp FROM (SELECT label, {prior} AS lp FROM nc) p),
s AS (SELECT id, sum(CASE WHEN ll.label = 0 THEN {tf} * w ELSE 0.0 END) AS s0, sum(CASE WHEN ll.label = 1 THEN {tf} * w ELSE 0.0 END) AS s1
      FROM counts JOIN ll ON counts.term = ll.term WHERE val GROUP BY id),
p AS (SELECT sp.id, sp.label, round(1.0 / (1.0 + exp((SELECT lp FROM pri WHERE label = 0) + coalesce(s0, 0.0) - (SELECT lp FROM pri WHERE label = 1) - coalesce(s1, 0.0))), 9) AS prob
      FROM sp LEFT JOIN s ON sp.id = s.id WHERE val)
SELECT id, label, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS prediction, {R6('prob')} AS prob FROM p"""


def nb_data(spark, sf):
    """Token counts, training rows, validation rows and vocabulary of the NB queries."""
    posts = SP.stratified_split(train_posts(spark, sf).withColumn("clean", TX.clean_post("post")), 0.2, 42)
    # cleaned, split and tokenised once: the vocabulary, the fit and the scores all read the counts
    posts = posts.select("id", "label", "split", "clean")
    c = FE.term_counts(FE.tokenize_words(posts, "clean").select("id", "tokens")).persist()
    posts = posts.select("id", "label", "split").persist()
    tr = posts.filter("split = 'train'").select("id", "label")
    va = posts.filter("split = 'val'").select("id", "label")
    tc = c.join(tr.select("id"), "id", "left_semi")
    return c, tc, tr, va, FE.build_vocabulary(tc, min_df=2, max_features=2000)


def nb_verdicts(model, c, va):
    s = NB.score_nb(model, c.join(va.select("id"), "id", "left_semi"), va)
    return r6(va.join(s, "id").select("id", "label", (F.col("prob") >= 0.5).cast("int").alias("prediction"), "prob"), {"prob"})


NB_FITS = {"multinomial": NB.fit_multinomial_nb, "complement": NB.fit_complement_nb, "bernoulli": NB.fit_bernoulli_nb}


def _nb_variant(kind):
    def fn(spark, sf):
        c, tc, tr, va, v = nb_data(spark, sf)
        return nb_verdicts(NB_FITS[kind](tc, tr, v), c, va)
    return fn


for _kind in NB_FITS:
    register(f"{_kind}_nb", _nb_sql(_kind))(_nb_variant(_kind))


# ---------------------------------------------------------------- more 2.2 / 2.6 / 2.10
from postlens.operators import scale as SCL  # noqa: E402

# Derived fixtures (FIXTURES C): a small valence lexicon and a lemma
# dictionary, drawn from words that occur in `documents`.
LEXICON = [("the", 0.1), ("and", 0.2), ("is", -0.3), ("was", -0.5), ("with", 0.4), ("that", -0.2), ("for", 0.3),
           ("this", 0.6), ("are", -0.4), ("de", 0.5), ("la", -0.6), ("der", 0.7), ("die", -1.2), ("que", 0.2)]
LEMMAS = [("is", "be"), ("are", "be"), ("was", "be"), ("were", "be"), ("has", "have"), ("had", "have"),
          ("does", "do"), ("did", "do")]


def _vals(rows):
    return ", ".join(f"({S.q(a)}, {b if not isinstance(b, str) else S.q(b)})" for a, b in rows)


@register("sigmoid_clip", f"SELECT id, model, {R6(S.sigmoid_sql('(prob - 0.5) * 1000.0'))} AS s FROM {SC}")
def q_sigmoid(spark, sf):
    sc = fx_scores(spark, sf)
    return sc.select("id", "model", F.round(TX.sigmoid_clip((F.col("prob") - 0.5) * 1000.0), 6).alias("s"))


@register("activation_expand", f"""WITH a AS (SELECT id, list(prob * 4.0 - 2.0 ORDER BY model) AS a FROM {SC} GROUP BY id),
e AS (SELECT id, list_transform(a, lambda x: greatest(x, 0.0)) || list_transform(a, lambda x: {S.sigmoid_sql('x')}) || list_transform(a, lambda x: tanh(x)) || list_transform(a, lambda x: CASE WHEN x > 0 THEN x ELSE 0.01 * x END) AS e FROM a)
SELECT id, generate_subscripts(e, 1) - 1 AS pos, {R6('unnest(e)')} AS value FROM e""")
def q_activation(spark, sf):
    sc = fx_scores(spark, sf)
    a = sc.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("model", (F.col("prob") * 4.0 - 2.0).alias("v")))).alias("_s"))
    a = a.select("id", F.transform("_s", lambda s: s["v"]).alias("a"))
    return _each(a.select("id", TX.activation_expand("a").alias("e")), "e", "value")


@register("one_hot", "SELECT d.doc_id, v.lang AS category, (d.lang = v.lang)::INT AS hot FROM documents d, (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL) v")
def q_one_hot(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return HY.one_hot(d, "lang", "doc_id")


@register("binarize_features", "SELECT vec_id, list_sum(list_transform(embedding, lambda x: (x > 0)::INT))::BIGINT AS n_pos FROM embeddings")
def q_binarize(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.aggregate(F.transform("embedding", lambda x: (x > 0).cast("long")), F.lit(0).cast("long"),
                                          lambda s, x: s + x).alias("n_pos"))


_LEX_SQL = f"""WITH lex(word, valence) AS (VALUES {_vals(LEXICON)}),
w AS (SELECT d.doc_id AS id, regexp_replace(unnest({S.words_sql('d.text', lower=True)}), '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g') AS word FROM documents d),
s AS (SELECT w.id, sum(lex.valence::DOUBLE) AS s FROM w JOIN lex ON w.word = lex.word GROUP BY w.id),
c AS (SELECT d.doc_id AS id, coalesce(s.s, 0.0)::DOUBLE AS s FROM documents d LEFT JOIN s ON d.doc_id = s.id)"""


def _lex(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("post"))
    lex = spark.createDataFrame(LEXICON, "word string, valence double")
    return HY.lexicon_sentiment(d, lex, "post")


@register("lexicon_sentiment", f"{_LEX_SQL} SELECT id, {R6('s')} + 0.0::DOUBLE AS s, {R6('s / sqrt(s * s + 15.0)')} + 0.0::DOUBLE AS compound FROM c")
def q_lexicon(spark, sf):
    x = _lex(spark, sf)
    # + 0.0: a sum that cancels to -0.0 is 0.0
    return x.select("id", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("s", "compound")])


@register("sentiment_label", f"{_LEX_SQL} SELECT CASE WHEN round(s / sqrt(s * s + 15.0), 9) >= 0 THEN 'positive' ELSE 'negative' END AS sentiment, count(*) AS n FROM c GROUP BY 1")
def q_sentiment_label(spark, sf):
    # round before the sign test: valence sums that cancel to ~1e-17 must not
    # depend on summation order
    x = _lex(spark, sf).withColumn("compound", F.round("compound", 9))
    return x.groupBy(HY.sentiment_label().alias("sentiment")).agg(F.count(F.lit(1)).alias("n"))


@register("dictionary_lemmatize", f"""WITH lem(word, lemma) AS (VALUES {_vals(LEMMAS)}),
p AS (SELECT id, {S.clean_sql('post')} AS clean FROM ({S.POSTS})),
w AS (SELECT id, unnest({S.words_sql('clean')}) AS word, generate_subscripts({S.words_sql('clean')}, 1) AS pos FROM p),
j AS (SELECT w.id, string_agg(coalesce(lem.lemma, w.word), ' ' ORDER BY w.pos) AS lemmatized FROM w LEFT JOIN lem ON w.word = lem.word GROUP BY w.id)
SELECT p.id, md5(coalesce(j.lemmatized, '')) AS lemmatized_md5, length(coalesce(j.lemmatized, '')) AS n_chars FROM p LEFT JOIN j ON p.id = j.id""")
def q_lemmatize(spark, sf):
    p = train_posts(spark, sf).select("id", TX.clean_post("post").alias("clean"))
    lem = spark.createDataFrame(LEMMAS, "word string, lemma string")
    x = HY.dictionary_lemmatize(p, lem, "clean")
    return x.select("id", F.md5("lemmatized").alias("lemmatized_md5"), F.length("lemmatized").cast("long").alias("n_chars"))


def _dense_sql(split):
    return (f"(SELECT vec_id AS id, embedding AS x FROM embeddings WHERE "
            f"{'NOT ' if split == 'train' else ''}({S.md5_uniform_sql('vec_id', 42)} < 0.2))")


def _each(df, array: str, out: str):
    """``id, pos`` and every value of an array."""
    return df.select("id", F.posexplode(array).alias("pos", "v")).select("id", F.col("pos").cast("long").alias("pos"), F.round("v", 6).alias(out))


@register("standard_scale", f"""WITH st AS (SELECT pos, avg(v) AS mu, CASE WHEN stddev_pop(v) = 0 OR stddev_pop(v) IS NULL THEN 1.0 ELSE stddev_pop(v) END AS sd
  FROM (SELECT unnest(x)::DOUBLE AS v, generate_subscripts(x, 1) AS pos FROM {_dense_sql('train')}) GROUP BY pos),
te AS (SELECT id, unnest(x)::DOUBLE AS v, generate_subscripts(x, 1) AS pos FROM {_dense_sql('val')})
SELECT te.id, te.pos - 1 AS pos, {R6('(te.v - st.mu) / st.sd')} AS scaled FROM te JOIN st ON te.pos = st.pos""")
def q_standard(spark, sf):
    tr, te = dense_split(spark, sf)
    x = SCL.standard_scale(te, SCL.fit_standard(tr))
    return _each(x, "x", "scaled")


@register("maxabs_scale", f"""WITH st AS (SELECT pos, CASE WHEN max(abs(v)) = 0 THEN 1.0 ELSE max(abs(v)) END AS m
  FROM (SELECT unnest(x)::DOUBLE AS v, generate_subscripts(x, 1) AS pos FROM {_dense_sql('train')}) GROUP BY pos),
te AS (SELECT id, unnest(x)::DOUBLE AS v, generate_subscripts(x, 1) AS pos FROM {_dense_sql('val')})
SELECT te.id, te.pos - 1 AS pos, {R6('te.v / st.m')} AS scaled FROM te JOIN st ON te.pos = st.pos""")
def q_maxabs(spark, sf):
    tr, te = dense_split(spark, sf)
    x = SCL.maxabs_scale(te, SCL.fit_maxabs(tr))
    return _each(x, "x", "scaled")


def _conf_rows_sql(cond):
    return f"""SELECT s.id, substr(p.post, 1, 100) AS text, s.label, {R6('greatest(s.prob, 1 - s.prob)')} AS confidence, {R6('1 - s.prob')} AS p0, {R6('s.prob')} AS p1
FROM {SC} s JOIN ({S.POSTS}) p ON s.id = p.id WHERE s.model = 'm_len' AND {cond} ORDER BY s.id LIMIT 5"""


def _conf_rows(spark, sf, cond):
    sc = fx_scores(spark, sf).filter(F.col("model") == "m_len")
    conf = F.greatest(F.col("prob"), 1 - F.col("prob"))
    x = sc.join(train_posts(spark, sf).select("id", "post"), "id").filter(cond(conf)).orderBy("id").limit(5)
    return x.select("id", F.substring("post", 1, 100).alias("text"), "label", F.round(conf, 6).alias("confidence"),
                    F.round(1 - F.col("prob"), 6).alias("p0"), F.round("prob", 6).alias("p1"))


@register("high_confidence_rows", _conf_rows_sql("greatest(s.prob, 1 - s.prob) > 0.9"))
def q_high_conf(spark, sf):
    return _conf_rows(spark, sf, lambda c: c > 0.9)


@register("uncertain_rows", _conf_rows_sql("greatest(s.prob, 1 - s.prob) > 0.4 AND greatest(s.prob, 1 - s.prob) < 0.6"))
def q_uncertain(spark, sf):
    return _conf_rows(spark, sf, lambda c: (c > 0.4) & (c < 0.6))


@register("cv_summary", f"""WITH f AS (SELECT id, (rk % 5)::INT AS fold FROM ({_rank_sql(42)})),
v AS (SELECT v.*, f.fold FROM {VOTES} v JOIN f ON v.id = f.id),
m AS (SELECT {S.metrics_select_sql(['model', 'fold'])} FROM ({S.confusion_sql('v', ['model', 'fold'])}))
SELECT model, {R6('avg(f1)')} AS mean, {R6('stddev_pop(f1)')} AS std, {R6('avg(f1) - 2 * stddev_pop(f1)')} AS lo, {R6('avg(f1) + 2 * stddev_pop(f1)')} AS hi FROM m GROUP BY model""")
def q_cv_summary(spark, sf):
    folds = SP.stratified_kfold(_posts_lab(spark, sf), 5, 42).select("id", "fold")
    v = _votes(spark, sf).join(folds, "id")
    m = EV.binary_metrics(v, ["model", "fold"], prob_col=None)
    return r6(EDA.cv_summary(m, ("model",), "f1"), {"mean", "std", "lo", "hi"})


# ---------------------------------------------------------------- 2.11 inspection of the NB model
@register("class_priors", _flagship_sql(f"SELECT label, {R6('exp(lp)')} AS prior FROM pri"))
def q_priors(spark, sf):
    m = FL.nb_model(spark, sf)
    return m.prior.select("label", F.round(F.exp("logprior"), 6).alias("prior"))


@register("nb_log_ratio", _flagship_sql(
    f"SELECT term, {R6('abs(max(CASE WHEN label = 1 THEN logp END) - max(CASE WHEN label = 0 THEN logp END))')} AS log_ratio FROM ll GROUP BY term"))
def q_nb_ratio(spark, sf):
    m = FL.nb_model(spark, sf)
    g = m.loglik.groupBy("term").agg(F.max(F.when(F.col("label") == 1, F.col("logp"))).alias("l1"),
                                     F.max(F.when(F.col("label") == 0, F.col("logp"))).alias("l0"))
    return g.select("term", F.round(F.abs(F.col("l1") - F.col("l0")), 6).alias("log_ratio"))


@register("nb_top_features_per_class", _flagship_sql(
    f"SELECT label, term, {R6('logp')} AS logp, rank FROM (SELECT label, term, logp, row_number() OVER (PARTITION BY label ORDER BY logp DESC, term ASC) AS rank FROM ll) WHERE rank <= 10"))
def q_nb_top(spark, sf):
    m = FL.nb_model(spark, sf)
    t = EDA.top_per_group(m.loglik, "label", "term", "logp", 10)
    return t.select("label", "term", F.round("logp", 6).alias("logp"), F.col("rank").cast("long").alias("rank"))


# ---------------------------------------------------------------- 2.8 / 2.10 comparisons over seeds and splits
def _seed_f1_sql(seeds):
    parts = []
    for sd in seeds:
        parts.append(f"""SELECT {sd} AS seed, v.* FROM {VOTES} v JOIN (SELECT id FROM ({_rank_sql(sd)}) WHERE rk < floor(n_c * 0.2)) h ON v.id = h.id""")
    src = "(" + " UNION ALL ".join(parts) + ")"
    return f"SELECT {S.metrics_select_sql(['model', 'seed'])} FROM ({S.confusion_sql(src, ['model', 'seed'])})"


def _seed_f1(spark, sf, seeds):
    v = _votes(spark, sf)
    out = None
    for sd in seeds:
        h = SP.stratified_split(_posts_lab(spark, sf), 0.2, sd).filter("split = 'val'").select("id")
        x = v.join(h, "id").withColumn("seed", F.lit(sd))
        out = x if out is None else out.unionByName(x)
    return EV.binary_metrics(out, ["model", "seed"], prob_col=None)


@register("experiment_summary", f"SELECT model AS algorithm, {R6('avg(f1)')} AS f1_mean, {R6('stddev_pop(f1)')} AS f1_std FROM ({_seed_f1_sql([1, 2, 3])}) GROUP BY model")
def q_experiment_summary(spark, sf):
    m = _seed_f1(spark, sf, [1, 2, 3])
    g = m.groupBy(F.col("model").alias("algorithm")).agg(F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std"))
    return r6(g, {"f1_mean", "f1_std"})


@register("repeated_holdout", f"SELECT model, seed, {R6('macro_f1')} AS macro_f1 FROM ({_seed_f1_sql([1, 2, 3])})")
def q_repeated_holdout(spark, sf):
    return r6(_seed_f1(spark, sf, [1, 2, 3]).select("model", F.col("seed").cast("int").alias("seed"), "macro_f1"), {"macro_f1"})


@register("train_test_gap", f"""WITH sp AS (SELECT id, CASE WHEN rk < floor(n_c * 0.2) THEN 'val' ELSE 'train' END AS split FROM ({_rank_sql(42)})),
v AS (SELECT v.*, sp.split FROM {VOTES} v JOIN sp ON v.id = sp.id),
m AS (SELECT {S.metrics_select_sql(['model', 'split'])} FROM ({S.confusion_sql('v', ['model', 'split'])}))
SELECT model, {R6("max(CASE WHEN split = 'train' THEN f1 END) - max(CASE WHEN split = 'val' THEN f1 END)")} AS f1_gap FROM m GROUP BY model""")
def q_gap(spark, sf):
    sp = SP.stratified_split(_posts_lab(spark, sf), 0.2, 42).select("id", "split")
    m = EV.binary_metrics(_votes(spark, sf).join(sp, "id"), ["model", "split"], prob_col=None)
    g = m.groupBy("model").agg((F.max(F.when(F.col("split") == "train", F.col("f1"))) -
                                F.max(F.when(F.col("split") == "val", F.col("f1")))).alias("f1_gap"))
    return r6(g, {"f1_gap"})


_ENS_SQL = f"""(SELECT 'soft_vote' AS model, label, CASE WHEN avg(prob) >= 0.5 THEN 1 ELSE 0 END AS prediction FROM {SC} GROUP BY id, label)"""
_CMP_SQL = f"""SELECT {S.metrics_select_sql(['model'])} FROM ({S.confusion_sql(f"(SELECT model, label, prediction FROM {VOTES} UNION ALL SELECT * FROM {_ENS_SQL})", ['model'])})"""


def _cmp(spark, sf):
    v = _votes(spark, sf).select("model", "label", "prediction")
    sc = fx_scores(spark, sf)
    ens = CB.soft_vote(sc).join(sc.select("id", "label").distinct(), "id").select(F.lit("soft_vote").alias("model"), "label", "prediction")
    return EV.binary_metrics(v.unionByName(ens), ["model"], prob_col=None)


@register("compare_models", f"""SELECT model, {R6('accuracy')} AS accuracy, {R6('f1')} AS f1, (f1 = max(f1) OVER ())::INT AS is_best FROM ({_CMP_SQL})""")
def q_compare(spark, sf):
    from pyspark.sql import Window

    m = _cmp(spark, sf)
    return r6(m.select("model", "accuracy", "f1", (F.col("f1") == F.max("f1").over(Window.partitionBy())).cast("int").alias("is_best")),
              {"accuracy", "f1"})


@register("ensemble_gain", f"""SELECT {R6("max(CASE WHEN model = 'soft_vote' THEN f1 END) - max(CASE WHEN model <> 'soft_vote' THEN f1 END)")} AS f1_gain FROM ({_CMP_SQL})""")
def q_gain(spark, sf):
    m = _cmp(spark, sf)
    return r6(m.agg((F.max(F.when(F.col("model") == "soft_vote", F.col("f1"))) -
                     F.max(F.when(F.col("model") != "soft_vote", F.col("f1")))).alias("f1_gain")), {"f1_gain"})


@register("tree_importance")
def q_tree_importance(spark, sf):
    tr, _ = dense_split(spark, sf)
    m = LIN.random_forest(n_trees=20, max_depth=6).fit(_vec(tr))
    imp = m.featureImportances.toArray().tolist()  # one value per feature: model-sized
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(imp)], "feature int, importance double").orderBy(F.desc("importance"))


@register("coefficient_importance")
def q_coef_importance(spark, sf):
    tr, _ = dense_split(spark, sf)
    m = LIN.logistic_regression(C=1.0, n=tr.count()).fit(_vec(tr))
    coef = m.coefficients.toArray().tolist()
    return spark.createDataFrame([(i, float(v), abs(float(v))) for i, v in enumerate(coef)],
                                 "feature int, coef double, abs_coef double").orderBy(F.desc("abs_coef"))


# ---------------------------------------------------------------- more 2.7 / 2.8 / 2.11
@register("margin_to_probability", f"SELECT id, model, {R6(S.sigmoid_sql('(prob - 0.5) * 8.0'))} AS p1, {R6('1.0 - ' + S.sigmoid_sql('(prob - 0.5) * 8.0'))} AS p0 FROM {SC}")
def q_margin_prob(spark, sf):
    sc = fx_scores(spark, sf)
    p1 = TX.sigmoid_clip((F.col("prob") - 0.5) * 8.0)
    return sc.select("id", "model", F.round(p1, 6).alias("p1"), F.round(F.lit(1.0) - p1, 6).alias("p0"))


@register("best_setting", f"""SELECT model, round(threshold, 2) AS threshold, {R6('macro_f1')} AS macro_f1 FROM (
  SELECT *, row_number() OVER (ORDER BY macro_f1 DESC, model ASC, threshold ASC) AS rk FROM (
  SELECT {S.metrics_select_sql(['model', 'threshold'])} FROM ({S.confusion_sql(
      f"(SELECT s.model, g.t AS threshold, s.label, CASE WHEN s.prob >= g.t THEN 1 ELSE 0 END AS prediction FROM {SC} s, (SELECT unnest(range(10, 90, 5)) / 100.0 AS t) g)",
      ['model', 'threshold'])}))) WHERE rk = 1""")
def q_best_setting(spark, sf):
    from pyspark.sql import Window

    s = EV.threshold_scan(fx_scores(spark, sf), EV.threshold_grid(10, 85, 5), group_cols=["model"])
    w = Window.orderBy(F.desc("macro_f1"), F.asc("model"), F.asc("threshold"))  # over the small results table
    b = s.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    return b.select("model", F.round("threshold", 2).alias("threshold"), F.round("macro_f1", 6).alias("macro_f1"))


def _lasso_coefs(spark, sf):
    tr, _ = dense_split(spark, sf)
    m = LIN.logistic_regression(C=1.0, n=tr.count(), l1_ratio=1.0).fit(_vec(tr))
    return [(i, float(v)) for i, v in enumerate(m.coefficients.toArray().tolist())]  # d values: model-sized


@register("signed_top_features")
def q_signed_top(spark, sf):
    from pyspark.sql import Window

    tr, _ = dense_split(spark, sf)
    m = LIN.logistic_regression(C=1.0, n=tr.count()).fit(_vec(tr))
    c = spark.createDataFrame([(i, float(v)) for i, v in enumerate(m.coefficients.toArray().tolist())], "feature int, coef double")
    c = c.withColumn("sign", F.when(F.col("coef") >= 0, "positive").otherwise("negative"))
    w = Window.partitionBy("sign").orderBy(F.desc(F.abs("coef")), "feature")
    return c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 5)


@register("selected_features")
def q_selected(spark, sf):
    c = spark.createDataFrame(_lasso_coefs(spark, sf), "feature int, coef double")
    return c.filter(F.abs("coef") > 1e-8)


@register("sparsity_info")
def q_sparsity(spark, sf):
    c = spark.createDataFrame(_lasso_coefs(spark, sf), "feature int, coef double")
    return c.agg(F.count(F.lit(1)).alias("total"), F.sum((F.abs("coef") > 1e-8).cast("int")).alias("non_zero"),
                 F.sum((F.abs("coef") <= 1e-8).cast("int")).alias("zero"),
                 F.avg((F.abs("coef") <= 1e-8).cast("double")).alias("sparsity_ratio"))


@register("model_info")
def q_model_info(spark, sf):
    tr, _ = dense_split(spark, sf)
    m = LIN.gradient_boosting(n_iter=20, lr=0.1, max_depth=3).fit(_vec(tr))
    rows = [(p.name, str(v)) for p, v in m.extractParamMap().items()]
    rows += [("total_num_nodes", str(m.totalNumNodes)), ("num_trees", str(m.getNumTrees))]
    return spark.createDataFrame(rows, "param string, value string")
