"""Quality rules as weak supervision, in DataFrame functions alone.

Each rule votes good (1), bad (-1) or abstains (0) from the base counts of a whole text. Over the texts that pass the base rule,
expectation-maximisation on the counts of vote patterns (at most 3^7 rows, whatever the corpus) estimates the share of good documents and, for
every rule, how often its vote is right on good and on bad ones. A document is kept when it passes the base rule and its
posterior probability of being good is at least `keep`: one bad vote of a rule that good documents often break is outvoted.
Estimates have no bounds but one: a rule's vote is never read as its opposite. A rule that is found no better than chance
has no weight.

A null text has no words (all counts 0, base rule failed). Null doc_ids and repeated rows are judged like any row. An
empty table gives no rows. Columns other than doc_id and text are ignored by rule_counts, kept by keep_good whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, materialize, read_table, spread

#: A text's words are the pieces between runs of these characters.
SPACES = r"[\\x20\\x09-\\x0D]"
WINDOW, ITERATIONS, KEEP = 8, 25, 0.5
#: Where estimation starts: the share of good documents, how often a vote on a good or a bad document is right; and
#: the number of documents and votes that this belief counts for.
PRIOR, RIGHT_ON_GOOD, RIGHT_ON_BAD, SMOOTHING = 0.8, 0.9, 0.5, 2.0

#: (name, good when, bad when): integer arithmetic only, so that every engine decides alike. Between the two a rule abstains.
RULES = (
    ("variety", "10 * n_distinct >= 6 * n_words", "10 * n_distinct < 4 * n_words"),
    ("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    ("lines", "n_dup_lines = 0 and n_lines >= 3", "4 * n_dup_lines > n_lines"),
    ("word_length", "10 * word_chars >= 45 * n_words and 10 * word_chars <= 60 * n_words", "10 * word_chars < 35 * n_words or 10 * word_chars > 70 * n_words"),
    ("marks", "50 * n_marks <= n_words", "10 * n_marks > n_words"),
    ("upper", "100 * n_upper <= 8 * n_letters", "4 * n_upper > n_letters"),
    ("letters", "100 * n_letters >= 93 * word_chars", "100 * n_letters < 88 * word_chars"),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_distinct", "n_letters", "n_upper")
BASE_FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"


def with_counts(docs: DataFrame, name: str) -> DataFrame:
    """docs and a column of that name: a structure of COUNTS of every text."""
    text = docs.select(F.struct("*").alias("row"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    plain = ("word_chars", "n_symbols", "n_marks", "n_letters", "n_upper")
    cut = text.select(
        "row",
        F.expr(f"filter(split(text, '{SPACES}+'), w -> w != '')").alias("words"),
        F.expr(f"length(regexp_replace(text, '{SPACES}+', ''))").cast("long").alias("word_chars"),
        F.expr("length(text) - length(translate(text, '#*$%&|<>', ''))").cast("long").alias("n_symbols"),
        F.expr("length(text) - length(translate(text, '!?', ''))").cast("long").alias("n_marks"),
        F.expr(r"length(regexp_replace(text, '[^\\p{L}\\p{M}]+', ''))").cast("long").alias("n_letters"),
        F.expr(r"length(regexp_replace(text, '[^\\p{Lu}]+', ''))").cast("long").alias("n_upper"),
        F.expr(rf"filter(split(text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
    )
    hashed = cut.select(
        "row", *plain,
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.expr("size(lines) - size(array_distinct(lines))").cast("long").alias("n_dup_lines"),
        F.expr("transform(words, w -> xxhash64(w))").alias("word_hashes"),
    )
    windows = hashed.withColumn("n_distinct", F.size(F.array_distinct("word_hashes")).cast("long"))
    windows = windows.withColumn("h", F.expr(f"if(n_words >= {WINDOW}, transform(sequence(1, size(word_hashes) - {WINDOW - 1}), i -> xxhash64(slice(word_hashes, i, {WINDOW}))), array())")).drop("word_hashes")
    # only texts with a repeated window are sorted
    ordered = windows.withColumn("s", F.expr("if(size(array_distinct(h)) < size(h), array_sort(transform(h, (x, i) -> struct(x as h, i as i))), null)")).drop("h")
    found = ordered.withColumn("p", F.expr("if(s is null, null, array_sort(transform(filter(s, (e, i) -> (i > 0 and s[i - 1].h = e.h) or (i < size(s) - 1 and s[i + 1].h = e.h)), e -> e.i)))")).drop("s")
    covered = F.expr(f"coalesce(aggregate(p, struct(0 as n, -{WINDOW} as last), (a, i) -> struct(a.n + least({WINDOW}, i - a.last) as n, i as last), a -> a.n), 0)")
    return found.withColumn("n_repeat_words", covered.cast("long")).select("row.*", F.struct(*COUNTS).alias(name))


def rule_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the base counts of every text."""
    return with_counts(docs.select("doc_id", "text"), "counts").select("doc_id", "counts.*")


def vote(good: str, bad: str) -> Column:
    return F.expr(f"case when {bad} then -1 when {good} then 1 else 0 end")


def estimate(patterns: list[tuple[tuple[int, ...], int]], n: int, iterations: int = ITERATIONS) -> tuple[float, list[float], list[float]]:
    """From counted vote patterns: the share of good documents, and for each of n rules how often its vote is right on good and on bad ones."""
    share, on_good, on_bad = PRIOR, [RIGHT_ON_GOOD] * n, [RIGHT_ON_BAD] * n
    patterns = sorted(patterns)
    total = sum(c for _, c in patterns)
    for _ in range(iterations if total else 0):
        right_good, good_votes, right_bad, bad_votes, good = [SMOOTHING * RIGHT_ON_GOOD] * n, [SMOOTHING] * n, [SMOOTHING * RIGHT_ON_BAD] * n, [SMOOTHING] * n, SMOOTHING * PRIOR
        for pattern, c in patterns:
            p = posterior(pattern, share, on_good, on_bad)
            good += c * p
            for j, v in enumerate(pattern):
                if v:
                    good_votes[j] += c * p
                    bad_votes[j] += c * (1 - p)
                    if v > 0:
                        right_good[j] += c * p
                    else:
                        right_bad[j] += c * (1 - p)
        share = good / (total + SMOOTHING)
        on_good = [r / v for r, v in zip(right_good, good_votes)]
        on_bad = [max(r / v, 1 - a) for r, v, a in zip(right_bad, bad_votes, on_good)]
    return share, on_good, on_bad


def weights(on_good: float, on_bad: float) -> tuple[float, float]:
    """Log odds that a good and a bad vote of a rule add."""
    return math.log(on_good / (1 - on_bad)), math.log((1 - on_good) / on_bad)


def posterior(pattern: tuple[int, ...], share: float, on_good: list[float], on_bad: list[float]) -> float:
    odds = math.log(share / (1 - share))
    for v, a, b in zip(pattern, on_good, on_bad):
        odds += weights(a, b)[v < 0] if v else 0.0
    return 1 / (1 + math.exp(-odds))


def judge(counts: DataFrame, keep: float = KEEP, rules: tuple = RULES) -> DataFrame:
    """Adds base_failed, quality_probability and kept to base counts. counts is read twice: pass a written table."""
    names = [f"v{j}" for j in range(len(rules))]
    votes = [vote(g, b).alias(v) for v, (_, g, b) in zip(names, rules)]
    patterns = counts.select(F.expr(BASE_FAILED).alias("failed"), *votes).groupBy("failed", *names).count().collect()  # at most 2 * 3^rules rows
    share, on_good, on_bad = estimate([(tuple(r[1:-1]), r[-1]) for r in patterns if not r["failed"]], len(rules))
    odds = F.lit(math.log(share / (1 - share)))
    for (_, good, bad), a, b in zip(rules, on_good, on_bad):
        up, down = weights(a, b)
        odds = odds + F.when(F.expr(bad), F.lit(down)).when(F.expr(good), F.lit(up)).otherwise(F.lit(0.0))
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    out = counts.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("quality_probability", probability)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality_probability") >= keep))


def op9_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = materialize(rule_counts(spread(read_table(spark, sf_dir, "documents"))), "rule-counts")
    return judge(counts).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    """The same by DuckDB; the estimation is a recursive query over the pattern counts."""
    n, ws = len(RULES), r"[\x20\x09-\x0D]"
    votes = ", ".join(f"case when {b} then -1 when {g} then 1 else 0 end as v{j}" for j, (_, g, b) in enumerate(RULES))
    vs = ", ".join(f"v{j}" for j in range(n))
    odds = "ln(e.share / (1 - e.share)) + " + " + ".join(f"case when v{j} > 0 then ln(e.a{j} / (1 - e.b{j})) when v{j} < 0 then ln((1 - e.a{j}) / e.b{j}) else 0 end" for j in range(n))

    def right(j: int, start: float, sign: str, p: str) -> str:
        return f"({SMOOTHING * start} + sum(case when v{j} {sign} 0 then c * {p} else 0 end)) / ({SMOOTHING} + sum(case when v{j} <> 0 then c * {p} else 0 end))"

    new = ", ".join([right(j, RIGHT_ON_GOOD, ">", "p") + f" as a{j}" for j in range(n)] + [right(j, RIGHT_ON_BAD, "<", "(1 - p)") + f" as b{j}" for j in range(n)])
    bounded = ", ".join([f"a{j}" for j in range(n)] + [f"greatest(b{j}, 1 - a{j})" for j in range(n)])
    begin = ", ".join(f"{v}::double as {x}{j}" for x, v in (("a", RIGHT_ON_GOOD), ("b", RIGHT_ON_BAD)) for j in range(n))
    return f"""
with recursive t as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, list_filter(regexp_split_to_array(text, '{ws}+'), lambda x: x <> '') as words,
  cast(length(regexp_replace(text, '{ws}+', '', 'g')) as bigint) as word_chars,
  cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
  cast(length(text) - length(regexp_replace(text, '[!?]', '', 'g')) as bigint) as n_marks,
  cast(length(regexp_replace(text, '[^\\p{{L}}\\p{{M}}]+', '', 'g')) as bigint) as n_letters,
  cast(length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g')) as bigint) as n_upper,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from t),
f as (select doc_id, words, cast(len(words) as bigint) as n_words, word_chars, n_symbols, n_marks, n_letters, n_upper, cast(len(lines) as bigint) as n_lines,
  cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(len(list_distinct(words)) as bigint) as n_distinct from w),
g as (select doc_id, i, list_aggregate(words[i:i + {WINDOW - 1}], 'string_agg', ' ') as g from (select doc_id, words, unnest(range(1, n_words - {WINDOW - 2})) as i from f where n_words >= {WINDOW})),
d as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as k from g) where k > 1),
r as (select doc_id, sum(least({WINDOW}, i - coalesce(last, i - {WINDOW}))) as n from (select doc_id, i, lag(i) over (partition by doc_id order by i) as last from d) group by doc_id),
b as (select f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words, n_lines, n_marks, n_distinct, n_letters, n_upper
  from f left join r on f.doc_id = r.doc_id),
k as (select *, {votes} from b),
q as (select {vs}, cast(count(*) as double) as c from k where not ({BASE_FAILED}) group by {vs}),
e as (select 0 as step, {PRIOR}::double as share, {begin}
  union all select step, share, {bounded} from (select step + 1 as step, ({SMOOTHING * PRIOR} + sum(c * p)) / (sum(c) + {SMOOTHING}) as share, {new}
  from (select e.step, q.*, 1 / (1 + exp(-({odds}))) as p from e, q where e.step < {ITERATIONS}) group by step))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  {BASE_FAILED} as base_failed, not ({BASE_FAILED}) and 1 / (1 + exp(-({odds}))) >= {KEEP} as kept
from k, (select * from e order by step desc limit 1) e"""


OP9_SQL = _oracle()


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns. Counts are written beside the rows once: nothing is shuffled."""
    own = fresh(docs.columns, "counts")
    counted = materialize(with_counts(docs, own), "rule-counts")
    verdict = judge(counted.select(F.struct("*").alias("row"), f"{own}.*"))
    return verdict.where("kept").select("row.*").drop(own)
