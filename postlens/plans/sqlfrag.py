"""DuckDB SQL fragments for the oracles.  They restate each operator's
semantics in plain SQL over the same Parquet tables."""

from __future__ import annotations

from postlens.functions.hashing import md5_bucket_sql, md5_uniform_sql  # noqa: F401
from postlens.functions.text import HATE_INDICATORS, MASK_CHARS, english_stop_words

WS = "[ \\t\\n\\x0B\\f\\r]"
PUNCT = "[!-/:-@\\[-`{-~]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def stop_list_sql() -> str:
    return "(" + ", ".join(q(w) for w in english_stop_words()) + ")"


POSTS = ("SELECT d.doc_id AS id, l.toxic AS label, d.text AS post FROM documents d "
         "JOIN labels l ON d.doc_id = l.doc_id")

# Edge rows of FIXTURES part D, appended to real tables in hygiene queries.
EDGE_ROWS = [
    (-1, None), (-2, ""), (-3, "   "), (-4, "word"), (-5, "ALL CAPS SHOUTING HERE"),
    (-6, "What!!! Really??? ok!"), (-7, "sooooo goooood"), (-8, "Café naïve Ωμέγα 東京"),
    (-9, "RT @user http://x.y #tag text"), (-10, "#hate_this @Some_One #Été2024 stupid!!"),
]


def edge_values_sql() -> str:
    vals = ", ".join(f"({i}::BIGINT, {'NULL' if t is None else q(t)})" for i, t in EDGE_ROWS)
    return f"(VALUES {vals}) e(id, post)"


def posts_with_edges_sql() -> str:
    return f"SELECT doc_id AS id, text AS post FROM documents UNION ALL SELECT id, post FROM {edge_values_sql()}"


def clean_sql(col: str) -> str:
    t = f"coalesce({col}, '')"
    t = f"regexp_replace({t}, 'http[^ \\t\\n\\x0B\\f\\r]+', '', 'g')"
    t = f"regexp_replace({t}, '@[A-Za-z0-9_]+|#[A-Za-z0-9_]+', '', 'g')"
    t = f"regexp_replace({t}, '[^A-Za-z \\t\\n\\x0B\\f\\r]', '', 'g')"
    t = f"regexp_replace({t}, '\\bRT\\b', '', 'g')"
    return f"lower({t})"


def words_sql(col: str, lower: bool = False) -> str:
    c = f"lower(coalesce({col}, ''))" if lower else f"coalesce({col}, '')"
    return f"list_filter(string_split_regex({c}, '{WS}+'), lambda w: w <> '')"


def nchar_class_sql(col: str, cls: str) -> str:
    return f"(length({col}) - length(regexp_replace({col}, '{cls}', '', 'g')))"


def count_sub_sql(col: str, s: str) -> str:
    return f"((length({col}) - length(replace({col}, {q(s)}, ''))) // {len(s)})"


def tokens_sql(col: str, stop: bool = True) -> str:
    t = f"regexp_extract_all(lower(coalesce({col}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}')"
    if stop:
        t = f"list_filter({t}, lambda x: x NOT IN {stop_list_sql()})"
    return t


def text_stats_sql(col: str) -> dict[str, str]:
    t = f"coalesce({col}, '')"
    den = f"greatest(length({t}), 1)::DOUBLE"
    w = words_sql(col)
    lw = words_sql(col, lower=True)
    wden = f"greatest(len({w}), 1)::DOUBLE"
    ind = " + ".join(f"(CASE WHEN contains(lower({t}), {q(x)}) THEN 1 ELSE 0 END)" for x in HATE_INDICATORS)
    msk = " + ".join(f"(CASE WHEN contains({t}, {q(x)}) THEN 1 ELSE 0 END)" for x in MASK_CHARS)
    sentences = f"len(list_filter(string_split({t}, '.'), lambda s: regexp_matches(s, '[^ \\t\\n\\x0B\\f\\r]')))"
    caps = (f"len(list_filter({w}, lambda x: regexp_matches(x, '\\p{{Lu}}') "
            f"AND NOT regexp_matches(x, '[\\p{{Ll}}\\p{{Lt}}]')))")
    return {
        "n_chars": f"length({t})::BIGINT",
        "n_words": f"len({w})::BIGINT",
        "n_sentences": f"{sentences}::BIGINT",
        "upper_ratio": f"{nchar_class_sql(t, '\\p{Lu}')} / {den}",
        "lower_ratio": f"{nchar_class_sql(t, '\\p{Ll}')} / {den}",
        "caps_word_ratio": f"{caps} / {wden}",
        "punct_ratio": f"{nchar_class_sql(t, PUNCT)} / {den}",
        "excl_ratio": f"{count_sub_sql(t, '!')} / {den}",
        "quest_ratio": f"{count_sub_sql(t, '?')} / {den}",
        "excl3_ratio": f"{count_sub_sql(t, '!!!')} / {den}",
        "quest3_ratio": f"{count_sub_sql(t, '???')} / {den}",
        "indicator_ratio": f"({ind}) / {wden}",
        "mask_ratio": f"({msk}) / {den}",
        "unique_word_ratio": f"CASE WHEN len({lw}) > 0 THEN len(list_distinct({lw}))::DOUBLE / len({lw}) ELSE 0.0 END",
        "mean_word_len": (f"CASE WHEN len({lw}) > 0 THEN list_sum(list_transform({lw}, lambda x: length(x)))::DOUBLE "
                          f"/ len({lw}) ELSE 0.0 END"),
        "mention_density": f"{count_sub_sql(t, '@')} / {den}",
        "hashtag_density": f"{count_sub_sql(t, '#')} / {den}",
    }


def sigmoid_sql(z: str) -> str:
    return f"(1.0 / (1.0 + exp(-greatest(-500.0, least(500.0, ({z})::DOUBLE)))))"


def metrics_select_sql(group_cols: list[str]) -> str:
    """Same definitions as ``metrics_from_counts``; expects tp fp fn tn."""
    g = "".join(f"{c}, " for c in group_cols)
    tp, fp, fn, tn = "tp::DOUBLE", "fp::DOUBLE", "fn::DOUBLE", "tn::DOUBLE"
    n = f"({tp} + {fp} + {fn} + {tn})"

    def sd(a, b):
        return f"(CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0.0 END)"
    f1_1 = sd(tp, f"{tp} + 0.5 * ({fp} + {fn})")
    f1_0 = sd(tn, f"{tn} + 0.5 * ({fp} + {fn})")
    po = sd(f"{tp} + {tn}", n)
    pe = sd(f"({tp} + {fp}) * ({tp} + {fn}) + ({tn} + {fn}) * ({tn} + {fp})", f"{n} * {n}")
    return (f"{g}{n}::BIGINT AS n, {po} AS accuracy, {sd(tp, f'{tp} + {fp}')} AS precision, "
            f"{sd(tp, f'{tp} + {fn}')} AS recall, {f1_1} AS f1, {f1_0} AS f1_0, "
            f"{sd(sd(tp, f'{tp} + {fp}') + f' * ({tp} + {fn}) + ' + sd(tn, f'{tn} + {fn}') + f' * ({tn} + {fp})', n)} AS weighted_precision, "
            f"{sd(sd(tp, f'{tp} + {fn}') + f' * ({tp} + {fn}) + ' + sd(tn, f'{tn} + {fp}') + f' * ({tn} + {fp})', n)} AS weighted_recall, ({f1_0} + {f1_1}) / 2 AS macro_f1, "
            f"{sd(f'{f1_1} * ({tp} + {fn}) + {f1_0} * ({tn} + {fp})', n)} AS weighted_f1, "
            f"CASE WHEN 1.0 - {pe} <> 0 THEN ({po} - {pe}) / (1.0 - {pe}) ELSE 0.0 END AS kappa, "
            f"{sd(f'{tp} * {tn} - {fp} * {fn}', f'sqrt(({tp} + {fp}) * ({tp} + {fn}) * ({tn} + {fp}) * ({tn} + {fn}))')} AS mcc")


def confusion_sql(src: str, group_cols: list[str], label="label", pred="prediction") -> str:
    g = ", ".join(group_cols)
    sel = f"{g}, " if g else ""
    gb = f"GROUP BY {g}" if g else ""
    return (f"SELECT {sel}sum(CASE WHEN {label}=1 AND {pred}=1 THEN 1 ELSE 0 END)::BIGINT AS tp, "
            f"sum(CASE WHEN {label}=0 AND {pred}=1 THEN 1 ELSE 0 END)::BIGINT AS fp, "
            f"sum(CASE WHEN {label}=1 AND {pred}=0 THEN 1 ELSE 0 END)::BIGINT AS fn, "
            f"sum(CASE WHEN {label}=0 AND {pred}=0 THEN 1 ELSE 0 END)::BIGINT AS tn FROM {src} {gb}")


def auc_sql(src: str, group_cols: list[str], prob="prob", label="label") -> str:
    g = ", ".join(group_cols)
    pg = f"PARTITION BY {g} " if g else ""
    sel = f"{g}, " if g else ""
    gb = f"GROUP BY {g}" if g else ""
    return (f"SELECT {sel}CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc "
            f"FROM (SELECT *, coalesce(sum(neg) OVER ({pg}ORDER BY {prob} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below "
            f"FROM (SELECT {sel}{prob}, sum(CASE WHEN {label}=1 THEN 1 ELSE 0 END)::DOUBLE AS pos, "
            f"sum(CASE WHEN {label}=1 THEN 0 ELSE 1 END)::DOUBLE AS neg FROM {src} GROUP BY {sel}{prob})) {gb}")
