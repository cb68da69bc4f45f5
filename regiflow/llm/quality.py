"""Operator 4: quality rules with risk-controlled thresholds, in DataFrame expressions only.

Each rule compares a rate of the text (per mille, whole numbers) with a cutoff.
Cutoffs come from a fixed grid and are chosen per stratum (language) on labelled
documents: for every stratum, rule and grid value the good labelled documents
that the cutoff would reject are counted, and the exact binomial tail
P(Bin(n, risk) <= rejected) is the p-value of "rejects more than ``risk`` of the
good documents".  The grid is tested as a fixed sequence from the loosest cutoff to
the strictest: what a stricter cutoff rejects includes what a looser one does, so
the p-values rise along it and no correction is due for the grid.  A cutoff is
admitted if its p-value is at most ``error`` divided by the number of sequences
(Bonferroni over strata, the pooled one included, and rules), and the strictest
admitted cutoff is used.  A stratum with too few labels to admit any takes the
cutoff admitted for all labelled documents together; ``pooled_rules`` lists the rules
for which it does.  With probability 1 - ``error`` no rule rejects more than ``risk`` of
the good documents of its own, or the pooled, stratum; all rules together reject at
most the sum.  If the pool has too few labels as well, the rule is off.

The base rules reject documents of fewer than 50 words and documents with over
half of their words in repeated three-word windows.

Defined cases: a null text counts as empty (base_failed); a null or undeclared
language is stratum ``other``; labels of one document are combined by their worst
value, null labels are no labels; no labels: the base rules alone decide; extra
columns are kept, input columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRATA = ("de", "en", "es", "fr")          # any other language: "other"
GRID = (20, 50, 100, 150, 200, 300, 400, 500, 600, 700, 800, 900)     # per mille
RULES = ("symbol_rate", "dup_line_rate", "repeat_rate", "capital_rate", "mark_rate")
RISK, ERROR = 0.01, 0.05

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACE = r"[ \\t\\n\\x0B\\f\\r]"

# Words in three-word windows that occur twice.  Window hashes are compared as a set first; only
# texts with a repetition sort them as (hash, place), so that equal ones are neighbours, and then
# unite [p, p + 3) over their places from left to right.  Arrays are bound with
# transform(array(..), x -> ..)[0], so that no rewrite of the plan can evaluate them per element.
_REPEATED = """transform(array(_w), w -> case when size(w) < 4 then 0L else transform(
    array(transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))),
    hashes -> case when size(array_distinct(hashes)) = size(hashes) then 0L else aggregate(
        transform(array(sort_array(transform(hashes, (h, i) -> struct(h as h, i as i)))),
          s -> sort_array(transform(filter(s, (x, k) -> coalesce(x.h = get(s, k - 1).h, false) or coalesce(x.h = get(s, k + 1).h, false)),
                                    x -> x.i)))[0],
        struct(0L as n, 0 as e), (a, p) -> struct(a.n + p + 3 - greatest(p, a.e) as n, p + 3 as e), a -> a.n) end)[0] end)[0]"""


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base columns, ``base_failed`` and the rules' rates."""
    new = {*BASE, *RULES, "base_failed", "_t", "_w", "_l", "_lines", "_capitals", "_marks"}
    keep = [f"`{c}`" for c in docs.columns if c.lower() not in new or c == text]
    x = docs.select(*keep, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    x = x.withColumn("_w", F.expr(f"array_remove(split(_t, '{_SPACE}+'), '')"))
    x = x.withColumn("_l", F.expr(f"filter(split(_t, '\\n'), l -> l rlike '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]')"))
    x = x.select(
        *keep, F.expr("cast(size(_w) as bigint)").alias("n_words"),
        F.expr("cast(length(array_join(_w, '')) as bigint)").alias("word_chars"),
        F.expr("cast(length(_t) - length(regexp_replace(_t, '[#*$%&|<>]', '')) as bigint)").alias("n_symbols"),
        F.expr("cast(size(_l) - size(array_distinct(_l)) as bigint)").alias("n_dup_lines"),
        F.expr(_REPEATED).alias("n_repeat_words"),
        F.expr("cast(size(_l) as bigint)").alias("_lines"),
        F.expr("cast(length(_t) - length(regexp_replace(_t, '[A-Z]', '')) as bigint)").alias("_capitals"),
        F.expr("cast(length(_t) - length(regexp_replace(_t, '[!?]', '')) as bigint)").alias("_marks"))
    rate = lambda n, of: F.expr(f"1000 * {n} div greatest({of}, 1)")
    return x.select(
        *keep, *BASE, F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
        rate("n_symbols", "word_chars").alias("symbol_rate"), rate("n_dup_lines", "_lines").alias("dup_line_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"), rate("_capitals", "word_chars").alias("capital_rate"),
        rate("_marks", "word_chars").alias("mark_rate"))


def stratum(lang: str = "lang") -> Column:
    return F.when(F.col(f"`{lang}`").isin(*STRATA), F.col(f"`{lang}`")).otherwise("other")


def tail(k: Column | str, n: Column | str, risk: float) -> Column:
    """P(Bin(n, risk) <= k), summed exactly term by term in logarithms; 1 from the mean on."""
    return F.expr(f"""case when {k} >= {risk} * {n} then 1.0D else aggregate(sequence(1L, greatest({k}, 1L)),
        struct({n} * ln(1 - {risk}D) as l, exp({n} * ln(1 - {risk}D)) as s),
        (a, i) -> if(i > {k}, a, struct(a.l + ln(({n} - i + 1) / i * {risk}D / (1 - {risk}D)) as l,
                  a.s + exp(a.l + ln(({n} - i + 1) / i * {risk}D / (1 - {risk}D))) as s)), a -> a.s) end""")


SEQUENCES = (len(STRATA) + 2) * len(RULES)      # tests that are corrected for: declared strata, "other", the pool
POOL = "*"
LABELS = 1 << 20        # ids of labelled documents that are broadcast, at most


def cutoffs(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
            risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, a cutoff per rule, null: none): a row per stratum that has good labelled documents, and the pool's."""
    good = labels.where("quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).where("q = 1 and t = 0").select("_id")
    # only labelled texts are rated here; few ids are broadcast, more are joined
    good = F.broadcast(good) if good.count() <= LABELS else good
    labelled = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("text"), stratum(lang).alias("stratum")).join(good, "_id")
    held = features(labelled, "text").select("stratum", "base_failed", *RULES)
    rejected = [F.sum((~F.col("base_failed") & (F.col(r) > c)).cast("long")).alias(f"{r}_{c}") for r in RULES for c in GRID]
    counts = held.rollup("stratum").agg(F.sum((~F.col("base_failed")).cast("long")).alias("n"), *rejected)   # a row per stratum, one for all
    allowed = error / SEQUENCES
    best = [F.least(*[F.when(tail(f"{r}_{c}", "n", risk) <= allowed, F.lit(c)) for c in GRID]).alias(f"{r}_cutoff") for r in RULES]
    return counts.select(F.coalesce("stratum", F.lit(POOL)).alias("_stratum"), *best)


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Every document with its base columns, rates, cutoffs, ``pooled_rules`` and ``kept``.

    The cutoffs are broadcast: one row per declared stratum and one for all others.
    """
    names = [f"{r}_cutoff" for r in RULES]
    found = cutoffs(docs, labels, doc_id, text, lang, risk, error).agg(
        F.map_from_entries(F.collect_list(F.struct("_stratum", F.struct(*names)))).alias("m"))
    limits = found.select("m", F.explode(F.array(*map(F.lit, (*STRATA, "other")))).alias("_stratum"))
    mine, pool = F.try_element_at("m", F.col("_stratum")), F.try_element_at("m", F.lit(POOL))
    pooled = F.filter(F.array(*[F.when(mine[c].isNull() & pool[c].isNotNull(), F.lit(r)) for r, c in zip(RULES, names)]), lambda x: x.isNotNull())
    limits = F.broadcast(limits.select("_stratum", *[F.coalesce(mine[c], pool[c]).alias(c) for c in names], pooled.alias("pooled_rules")))
    own = {"kept", "pooled_rules", "_stratum", *names}
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in own])
    rated = features(docs, text).join(limits, stratum(lang) == F.col("_stratum"))
    # one least() and no conjunction: a filter on ``kept`` then stays above the rates it needs
    passes = F.least((~F.col("base_failed")).cast("int"), *[F.coalesce((F.col(r) <= F.col(f"{r}_cutoff")).cast("int"), F.lit(1)) for r in RULES]) == 1
    return rated.withColumn("kept", passes).drop("_stratum")


def verdicts(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", *BASE, "base_failed", "kept")


def oracle() -> str:
    """The same verdicts in DuckDB SQL; the binomial tail by gamma functions."""
    counted = ", ".join(f"sum(({r} > {c})::int) as {r}_{c}" for r in RULES for c in GRID)
    p = lambda k: (f"case when {k} >= {RISK} * n then 1.0 else list_sum(list_transform(range(0, ({k} + 1)::bigint), lambda i: "  # noqa: E731
                   f"exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK})))) end")
    best = ", ".join("least(" + ", ".join(f"case when {p(f'{r}_{c}')} <= {ERROR / SEQUENCES!r} then {c} end" for c in GRID) + f") as {r}_cutoff" for r in RULES)
    rates = {"symbol_rate": ("n_symbols", "word_chars"), "dup_line_rate": ("n_dup_lines", "n_lines"), "repeat_rate": ("n_repeat_words", "n_words"),
             "capital_rate": ("n_capitals", "word_chars"), "mark_rate": ("n_marks", "word_chars")}
    rate = ", ".join(f"1000 * {a} // greatest({b}, 1) as {r}" for r, (a, b) in rates.items())
    passes = " and ".join(f"coalesce({r} <= coalesce(k.{r}_cutoff, pool.{r}_cutoff), true)" for r in RULES)
    return rf"""
with t as (select doc_id, coalesce(text, '') as t, case when lang in {STRATA!r} then lang else 'other' end as stratum from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
      list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l from t),
one as (select doc_id, unnest(range(1, len(w) - 1)) as i,
        unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as g from w where len(w) >= 3),
win as (select doc_id, i, count(*) over (partition by doc_id, g) as c from one),
rep as (select doc_id, count(distinct i + d) as n from win, (values (0), (1), (2)) x(d) where c > 1 group by doc_id),
b as materialized (select doc_id, stratum, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
      (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words, len(l) as n_lines,
      length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_capitals, length(t) - length(regexp_replace(t, '[!?]', '', 'g')) as n_marks
      from w left join rep using (doc_id)),
r as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, {rate} from b),
good as (select doc_id from labels where quality is not null group by doc_id having min(quality) = 1 and max(coalesce(toxic, 0)) = 0),
n as materialized (select coalesce(stratum, '{POOL}') as stratum, count(*) as n, {counted} from r join good using (doc_id) where not base_failed
      group by rollup (stratum)),
k as materialized (select stratum, {best} from n where n > 0)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {passes} as kept
from r left join k using (stratum) left join k pool on pool.stratum = '{POOL}'"""
