"""Personal data by weak supervision (native): labelers vote on candidate spans,
expectation-maximisation weighs the labelers, a span classifier decides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import keep, table

KINDS = ("email", "ip", "card", "phone")
#: Base patterns.  A match starts at the head of its run of characters or where the
#: last match ended: no other start can be leftmost, and long runs stay linear.
#: Possessive parts give up nothing that a later part could use.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser candidates, which only the classifier can accept.
LOOSE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+.-])\(?[2-9][0-9]{2}[)\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
#: Gazetteers: top-level domains, first octets in public use, issuer prefixes, calling codes.
DOMAINS = "com org net edu gov mil int info biz eu de fr es uk us ca ch at it nl be br mx ar cl jp cn in au io dev".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|30[0-5]|36|38|35|6011|65|62)"
CALLING = r"^\+?(?:1|7|2[07]|3[0-69]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
#: Words before a span that speak for it, and characters that speak against it.
CONTEXT = {
    "email": r"(?i)(?:mail|contact|write|reply|from|to)\P{L}*$",
    "ip": r"(?i)(?:\bip|host|server|address|addr|login|client)\P{L}*$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|pay)\P{L}*$",
    "phone": r"(?i)(?:phone|call|tel|mobile|cell|fax|sms|whatsapp)\P{L}*$",
}
AGAINST = r"(?:[=\"'/$#_€]|\bv(?:er)?\.?\s?)$"
NEAR, ROUNDS, ACCEPT = 24, 50, 0.9
BLOCK = 256  # matches a block, in prefix sums and overlaps
ABSTAIN = 2  # votes: 0 against, 1 for, 2 none
LABELERS = 3


def pieces(text: Column, pattern: str) -> Column:
    """The text cut at its matches, which are leftmost and do not overlap: (g, w, t) =
    length of the gap, its last characters, the match after it (null after the last)."""
    rows = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                      lambda gap, t: F.struct(F.length(gap).alias("g"), F.right(gap, F.lit(NEAR)).alias("w"), t.alias("t")))
    return F.when(text.rlike(pattern), rows).otherwise(F.expr("cast(array() as array<struct<g:int,w:string,t:string>>)"))


def blocks(a: Column) -> Column:
    """An array in slices of ``BLOCK``; one empty slice of an empty one."""
    last = F.floor(F.greatest(F.size(a) - 1, F.lit(0)) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(a, b * BLOCK + 1, BLOCK))


def starts(p: Column) -> Column:
    """Code points before each match of ``pieces``: prefix sums, block by block, so that
    no array grows longer than a block or the number of blocks."""
    width = lambda x: x["g"] + F.coalesce(F.length(x["t"]), F.lit(0))
    none = F.expr("cast(array() as array<int>)")

    def sums(rows, at, add, here):
        begin = F.struct(at.alias("at"), none.alias("s"))
        step = lambda acc, x: F.struct((acc["at"] + add(x)).alias("at"), F.concat(acc["s"], F.array(acc["at"] + here(x))).alias("s"))
        return F.aggregate(rows, begin, step, lambda acc: acc["s"])

    totals = F.transform(blocks(p), lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + width(x)))
    offsets = sums(totals, F.lit(0), lambda x: x, lambda x: F.lit(0))
    return F.flatten(F.zip_with(blocks(p), offsets, lambda b, at: sums(b, at, width, lambda x: x["g"])))


def before(p: Column, i: Column) -> Column:
    """The ``NEAR`` code points before match ``i``, from its gap and the pieces ahead of
    it; a match and the gap before it have at least 3, or it is the first."""
    prior = [F.coalesce(F.concat(F.get(p, i - j)["w"], F.right(F.get(p, i - j)["t"], F.lit(NEAR))), F.lit("")) for j in range(NEAR // 3, 0, -1)]
    return F.right(F.concat(*prior, F.get(p, i)["w"]), F.lit(NEAR))


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, less 9 over 9, sums to a multiple of 10."""
    each = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    one = F.transform(each, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(one, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, t: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(t, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(F.substring(part(p), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        n = F.length(_digits(t))
        return F.when((n >= 12) & (n <= 19), luhn(_digits(t))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(t)).between(9, 15)
    return F.lit(True)


def _known(kind: str, t: Column) -> Column:
    """The gazetteer labeler."""
    if kind == "email":
        return F.lower(F.regexp_extract(F.right(t, F.lit(NEAR)), "([A-Za-z0-9]+)[^A-Za-z0-9]*$", 1)).isin(DOMAINS)
    if kind == "ip":
        first = F.substring(F.regexp_extract(t, "^0*([0-9]{0,3})", 1), 1, 3).try_cast("int")
        return F.coalesce(first.between(1, 223) & (first != 127), F.lit(False))
    if kind == "card":
        return _digits(t).rlike(ISSUERS)
    return F.regexp_replace(t, "[^0-9+]", "").rlike(CALLING)


def _fence(df: DataFrame, keep_cols: list[str], **cols: Column) -> DataFrame:
    """Adds columns behind a generator, so that none is put into another's lambda, where
    it would be evaluated once per element."""
    made = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select(*keep_cols, F.explode(F.array(made)).alias("_m")).select(*keep_cols, *[F.col(f"_m.{n}").alias(n) for n in cols])


def _spans(kind: str, p: Column, s: Column, base: bool) -> Column:
    """Matches as spans: base ones with the regex labeler's vote, loose ones on which it
    abstains."""
    found = F.filter(F.transform(p, lambda x, i: F.struct(F.get(s, i).alias("start"), x["t"].alias("t"), i.alias("i"))), lambda m: m["t"].isNotNull())
    if base and kind == "card":  # shorter and longer runs of digits are no candidates at all
        found = F.filter(found, lambda m: F.length(_digits(m["t"])).between(12, 19))
    good = lambda m: valid(kind, m["t"]) if base else F.lit(False)
    vote = lambda m: F.when(valid(kind, m["t"]), 1).otherwise(0) if base else F.lit(ABSTAIN)
    return F.transform(found, lambda m: F.struct(F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), (m["start"] + F.length(m["t"])).alias("end"), m["t"].alias("t"),
                                                 good(m).alias("base"), vote(m).alias("v1"), before(p, m["i"]).alias("before")))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: array of (kind, start, end, base, v1, v2, v3, size) of
    every row of ``docs``; of each kind base spans first, in the text's order."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    patterns = {f"{k}_{b}": (BASE if b else LOOSE)[k] for k in KINDS for b in (1, 0) if b or k in LOOSE}
    d = _fence(d, ["doc_id"], **{n: pieces(F.col("text"), x) for n, x in patterns.items()})
    d = _fence(d, ["doc_id", *patterns], **{f"{n}_at": starts(F.col(n)) for n in patterns})
    every = F.concat(*[_spans(n[:-2], F.col(n), F.col(f"{n}_at"), n.endswith("1")) for n in patterns])

    def finish(s):
        by_kind = lambda f: F.coalesce(*[F.when(s["kind"] == i, f(k)) for i, k in enumerate(KINDS)])
        known = by_kind(lambda k: _known(k, s["t"]))
        says = by_kind(lambda k: s["before"].rlike(CONTEXT[k]))
        context = F.when(s["before"].rlike(AGAINST), 0).when(says, 1).otherwise(ABSTAIN)
        size = F.least(F.floor((s["end"] - s["start"]) / 8), F.lit(3)).cast("int")
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"), s["v1"].alias("v1"),
                        known.cast("int").alias("v2"), context.alias("v3"), size.alias("size"))

    return d.select("doc_id", F.transform(every, finish).alias("spans"))


def reliabilities(cells: dict[tuple, float], rounds: int = ROUNDS) -> dict[tuple, float]:
    """Expectation-maximisation over the counts of (kind, votes, size) cells: every
    labeler has a table P(vote | truth) per kind.  Returns P(span is real) by cell.
    Starts from the share of for-votes."""
    post = {}
    for c in cells:
        votes = [v for v in c[1:1 + LABELERS] if v != ABSTAIN]
        post[c] = (sum(votes) + 0.5) / (len(votes) + 1)
    for _ in range(rounds):
        prior, table_ = {}, {}
        for kind in {c[0] for c in cells}:
            own = [c for c in cells if c[0] == kind]
            for truth in (0, 1):
                weight = {c: cells[c] * (post[c] if truth else 1 - post[c]) for c in own}
                prior[kind, truth] = sum(weight.values()) + 1
                for j in range(LABELERS):
                    # one smoothing count a vote, with labelers taken to be better than chance
                    seen = [0.5 + (v == truth) for v in (0, 1)] + [0.5]
                    for c, w in weight.items():
                        seen[c[1 + j]] += w
                    table_[kind, j, truth] = [x / sum(seen) for x in seen]
        for c in cells:
            z = [math.log(prior[c[0], t]) + sum(math.log(table_[c[0], j, t][c[1 + j]]) for j in range(LABELERS)) for t in (0, 1)]
            post[c] = 1 / (1 + math.exp(min(700, max(-700, z[0] - z[1]))))
    return post


def _features(cell: tuple) -> list[int]:
    """Active one-hot features of a cell: kind, every vote by kind, size class."""
    kind, *votes, size = cell
    return [kind] + [4 + (kind * LABELERS + j) * 3 + v for j, v in enumerate(votes)] + [4 + 4 * LABELERS * 3 + size]


def train_classifier(cells: dict[tuple, float], post: dict[tuple, float], steps: int = 300, l2: float = 1e-3) -> list[float]:
    """Logistic regression of the posteriors on the cells' features (gradient ascent
    with momentum on the weighted mean log likelihood)."""
    w, move = [0.0] * (4 + 4 * LABELERS * 3 + 4), [0.0] * (4 + 4 * LABELERS * 3 + 4)
    by_kind = {}
    for c, n in cells.items():
        by_kind[c[0]] = by_kind.get(c[0], 0) + n
    for _ in range(steps):
        g = [-l2 * x for x in w]
        for c, n in cells.items():
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w[i] for i in _features(c))))))
            for i in _features(c):
                g[i] += n / by_kind[c[0]] * (post[c] - p)
        move = [0.9 * m + 0.3 * x for m, x in zip(move, g)]
        w = [x + m for x, m in zip(w, move)]
    return w


def find_pii(docs: DataFrame, accept: float = ACCEPT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row.

    ``n_*`` and ``base_sha256`` tell of the base spans; ``spans`` has these and the
    candidates that the classifier accepts, which do not overlap a base span.  The
    labelers are the pattern with its checks, a gazetteer and the text before the
    span.  What is learnt is learnt from the vote counts of all documents: a table
    of a few hundred cells.

    A text's matches are numbered and compared in blocks: work on a long text is linear
    in its length and, but for a 256th of their square, in its matches.

    Null and empty texts have no spans.  Repeated rows, null ids: one result each.
    Empty table: no rows.  Other columns are not read."""
    c = keep(candidates(docs, id_col, text_col), "pii")
    names = ("kind", "v1", "v2", "v3", "size")
    counts = c.select(F.explode("spans").alias("s")).groupBy(*[F.col(f"s.{n}").alias(n) for n in names]).count().collect()
    cells = {tuple(r[n] for n in names): float(r["count"]) for r in counts}
    weights = train_classifier(cells, reliabilities(cells))
    good = [c for c in cells if sum(weights[i] for i in _features(c)) >= math.log(accept / (1 - accept))]
    code = lambda s: (((s["kind"] * 3 + s["v1"]) * 3 + s["v2"]) * 3 + s["v3"]) * 4 + s["size"]
    codes = [(((k * 3 + a) * 3 + b) * 3 + d) * 4 + z for k, a, b, d, z in good]
    base = F.filter("spans", lambda s: s["base"])
    meets = lambda s, lo, hi: (lo < s["end"]) & (s["start"] < hi)
    inside = lambda s: F.coalesce(F.exists("blocks", lambda b: meets(s, b["lo"], b["hi"]) & F.exists(b["rows"], lambda x: meets(s, x["start"], x["end"]))), F.lit(False))
    free = F.filter("spans", lambda s: ~s["base"] & code(s).isin(codes) & ~inside(s))
    name = F.array(*[F.lit(k) for k in KINDS])

    def text_of(spans):
        order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
        return F.array_join(F.transform(order, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    c = _fence(c, ["doc_id", "spans"], base=base)
    # spans are in order of kind and start: a block of them lies close together
    ranges = F.transform(blocks(F.col("base")), lambda b: F.struct(F.array_min(F.transform(b, lambda x: x["start"])).alias("lo"), F.array_max(F.transform(b, lambda x: x["end"])).alias("hi"), b.alias("rows")))
    c = _fence(c, ["doc_id", "spans", "base"], blocks=ranges)
    number = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return c.select("doc_id", *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(text_of(F.col("base")), 256).alias("base_sha256"),
                    text_of(F.concat("base", free)).alias("spans"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
