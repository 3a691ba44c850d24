"""Quality rules: divergence of a document's profile from language references.

Two histograms describe a document: its character classes, and the language's
common words against all other words. A language's reference is the mean
histogram of the documents of that ``lang`` that pass the base rules. Languages
that hold ``SOLID_SHARE`` of those documents (a handful at most), and the most
frequent one, are taken for granted; any other gives a reference only if half of
its documents or more lie near one of those by their classes (all letters as one).

A document's Jensen-Shannon distances (base 2) to a reference are held against
limits that widen for short texts; it is kept if its two distances to a language
taken for granted, or to its own language, both stay within them, so a wrong
``lang`` does no harm among the frequent ones. Shares decide, never numbers of
rows: a table that is held several times over gives the same verdicts. Everything
runs as DataFrame expressions; only the references taken for granted reach the
driver and return as literals, the others are a table that joins on ``lang``.

Defined results: null or blank text has no words and fails the base rules; a
text below ``min_words`` is never judged by divergence, nor does it support a
reference; texts of a language without a reference are held against those taken
for granted by their classes alone, all letters as one, since another language's
common words say nothing; texts without a language against those by classes and
words; with no reference at all nothing is judged by divergence; equal rows get
equal results; other input columns pass through, those named like a result column
are replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martlet.llm.registry import SPACE, WORD, read_table, register
from martlet.session import cut_lineage

# Frequent function words of the references' languages.
COMMON = tuple(sorted({
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "with", "was", "on", "be", "by",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "que", "est", "pour", "qui", "dans",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "ist", "im", "auf",
    "el", "y", "los", "se", "del", "las", "por", "con", "una", "su", "para", "al",
}))

# Character classes that are counted (Java syntax); what is left
# are the letters a to z, by far the largest class.
CLASSES = (r"\x20\x09-\x0D", "#*$%&|<>", "A-Z", "0-9", ".,;:!?", r"\x{80}-\x{10FFFF}",
           r"\x00-\x08\x0E-\x1F\x7F\"'()+/=@\\\[\]^_`{}~\-")

RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
MIN_WORDS = 50
# The word limits follow clean text: chosen on one half of sf0.1's labels, held against the other.
CHAR_LIMIT, CHAR_SLACK, WORD_LIMIT, WORD_SLACK = 0.15, 1.0, 0.06, 2.2
# Share of the texts from which a language is taken for granted (so at most six are, or seven with
# the most frequent one); distance within which half of another's texts lie; limit of texts whose
# language has no reference.
SOLID_SHARE, FAR_LIMIT, OTHER_LIMIT = 0.15, 0.12, 0.10
OTHER_SCRIPTS = 5  # place of the letters beyond ASCII in CLASSES


def _count_of(text: Column, chars: str) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, f"[{chars}]+", ""))).cast("long")


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _window(words: str, i: Column) -> list[Column]:
    return [F.get(words, i + j) for j in range(3)]


def _sorted_windows(words: str, n: Column) -> Column:
    """Hashes of the three-word windows, sorted. A hash keeps its upper bits and
    carries its position in the lower ones, so that one primitive sort puts
    equal windows side by side."""
    low = _position_bits(n)
    packed = F.transform(F.sequence(F.lit(0), n.cast("int") - 3), lambda i: F.xxhash64(*_window(words, i))
                         .bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))
    return F.when(n >= 4, F.sort_array(packed))


def _position_bits(n: Column) -> Column:
    """Mask of the bits that hold a position below ``n``."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n))) - 1


def _repeated_starts(words: str, windows: str, low: str) -> Column:
    """Positions of windows that occur twice or more: neighbours in the sorted
    array with equal hashes, confirmed word by word."""
    def pair(x: Column, i: Column) -> Column:
        a, b = x.bitwiseAND(F.col(low)).cast("int"), F.get(windows, i + 1).bitwiseAND(F.col(low)).cast("int")
        tests = [F.bitwise_not(F.col(low)).bitwiseAND(x.bitwiseXOR(F.get(windows, i + 1))) == 0]
        tests += [p == q for p, q in zip(_window(words, a), _window(words, b))]
        return F.when(functools.reduce(Column.__and__, tests), F.array(a, b))

    pairs = F.filter(F.transform(windows, pair), lambda p: p.isNotNull())
    return F.sort_array(F.array_distinct(F.flatten(pairs)))


def _covered(starts: str) -> Column:
    """Words inside the three-word windows that begin at the sorted ``starts``."""
    steps = F.transform(starts, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - p, F.lit(3))))
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long")


def measured(documents: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all), the base counts, and a profile:
    ``_chars`` (class counts), ``_cats`` and ``_freq`` (numbers of the common
    words present, and how often), ``_total`` (words of letters)."""
    keep = [c for c in (documents.columns if keep is None else keep) if c not in RESULT]
    t = F.coalesce(F.col(text), F.lit(""))
    common = F.array(*[F.lit(w) for w in COMMON])
    # Each step holds as few wide columns as it can: rows are copied from step to step.
    df = documents.select(
        *keep, F.filter(F.split(t, SPACE), lambda w: w != "").alias("_words"), _dup_lines(t).alias("n_dup_lines"),
        F.split(F.lower(t), r"[^\p{L}]+").alias("_plain"), F.char_length(t).cast("long").alias("_length"),
        *[_count_of(t, c).alias(f"_c{i}") for i, c in enumerate(CLASSES)])
    counts = [f"_c{i}" for i in range(len(CLASSES))]
    n = F.size("_words").cast("long")
    df = df.select(
        *keep, "n_dup_lines", "_length", *counts, "_words", n.alias("n_words"), _position_bits(n).alias("_low"),
        _sorted_windows("_words", n).alias("_windows"),
        (F.size("_plain") - F.size(F.filter("_plain", lambda w: w == ""))).alias("_total"),
        F.sort_array(F.transform(F.filter("_plain", lambda w: w.isin(*COMMON)),
                                 lambda w: F.array_position(common, w))).alias("_hits"))
    ends = F.filter(F.transform("_hits", lambda h, i: F.when(
        F.coalesce(F.get("_hits", i + 1) != h, F.lit(True)), i)), lambda i: i.isNotNull())
    df = df.select(
        *keep, "n_dup_lines", "_length", *counts, "n_words", "_total", "_hits", ends.alias("_ends"),
        _repeated_starts("_words", "_windows", "_low").alias("_starts"))
    return df.select(
        *keep, "n_words", (F.col("_length") - F.col("_c0")).alias("word_chars"), F.col("_c1").alias("n_symbols"),
        "n_dup_lines", _covered("_starts").alias("n_repeat_words"), "_total",
        F.array(*counts, F.col("_length") - sum(F.col(c) for c in counts)).alias("_chars"),
        F.transform("_ends", lambda i: F.get("_hits", i)).alias("_cats"),
        F.transform("_ends", lambda i, j: i - F.coalesce(F.get("_ends", j - 1), F.lit(-1))).alias("_freq"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def references(profiles: DataFrame, lang: str = "lang", min_words: int = MIN_WORDS) -> tuple[dict, DataFrame | None]:
    """Mean histograms (character classes, common words) of languages, from the
    texts of ``min_words`` or more that pass the base rules: those taken for
    granted as a dictionary, the others as a table (_lang, _ref_chars, _ref_words)."""
    k, n = len(CLASSES) + 1, len(COMMON)
    use = profiles.filter((F.col("n_words") >= min_words) & ~F.col("base_failed") & F.col(lang).isNotNull())
    size = sum(F.get("_chars", F.lit(i)) for i in range(k))

    def entry(i, share):
        return F.struct(i.cast("int").alias("i"), share.cast("double").alias("share"))

    entries = F.concat(
        F.array(entry(F.lit(-1), F.lit(1.0))), F.transform("_chars", lambda c, i: entry(i, c / size)),
        F.transform(F.arrays_zip(F.col("_cats").alias("c"), F.col("_freq").alias("f")),
                    lambda x: entry(x["c"] - 1 + k, x["f"] / F.col("_total"))))
    # A row per language and histogram entry, pre-aggregated before the shuffle.
    sums = cut_lineage(use.select(F.col(lang).alias("_lang"), F.explode(entries).alias("e"))
                       .groupBy("_lang", "e.i").agg(F.sum("e.share").alias("s")), "profile-sums")
    support = sums.filter("i = -1")
    total, top = support.agg(F.sum("s"), F.min_by("_lang", F.struct(-F.col("s"), "_lang"))).first()
    if top is None:
        return {}, None
    granted = {r["_lang"] for r in support.filter(F.col("s") >= SOLID_SHARE * total).collect()} | {top}
    parts: dict[str, dict[int, float]] = {}
    for r in sums.filter(F.col("_lang").isin(*granted)).collect():
        parts.setdefault(r["_lang"], {})[r["i"]] = r["s"]
    solid = {}
    for name, x in sorted(parts.items()):
        w = [x.get(k + i, 0.0) / x[-1] for i in range(n)]
        solid[name] = ([x.get(i, 0.0) / x[-1] for i in range(k)], [*w, max(0.0, 1 - sum(w))])

    far = F.array_min(F.array(*[_char_distance(c, _one_alphabet) for c, _ in solid.values()]))
    near = (use.filter(~F.col(lang).isin(*granted)).groupBy(F.col(lang).alias("_lang"))
            .agg(F.count_if(far <= FAR_LIMIT).alias("near"), F.count("*").alias("n")).filter("2 * near >= n").select("_lang"))

    def shares(first: int, count: int) -> Column:
        return F.transform(F.sequence(F.lit(first), F.lit(first + count - 1)),
                           lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)) / F.element_at("m", F.lit(-1)))

    # An entry per class and common word: bounded by the lists above.
    other = (sums.join(near, "_lang", "left_semi").groupBy("_lang")
             .agg(F.map_from_entries(F.collect_list(F.struct("i", "s"))).alias("m"))
             .select("_lang", shares(0, k).alias("_ref_chars"), shares(k, n).alias("w")))
    rest = F.greatest(F.lit(0.0), 1 - F.aggregate("w", F.lit(0.0), lambda a, x: a + x))
    return solid, cut_lineage(other.select("_lang", "_ref_chars", F.array_append("w", rest).alias("_ref_words")), "references")


def _one_alphabet(classes: list) -> list:
    """Class values with the letters of all scripts as one class."""
    return [*classes[:OTHER_SCRIPTS], *classes[OTHER_SCRIPTS + 1:-1], classes[OTHER_SCRIPTS] + classes[-1]]


def _term(p: Column, q: Column) -> Column:
    """Twice a category's share of the squared distance."""
    def part(x):
        return F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)
    return part(p) + part(q)


def _char_distance(ref: list, fold: Callable[[list], list] = list) -> Column:
    """``ref``: the classes' shares, as numbers or columns."""
    counts = [F.get("_chars", F.lit(i)) for i in range(len(CLASSES) + 1)]
    size = sum(counts)
    shares = [q if isinstance(q, Column) else F.lit(q) for q in fold(ref)]
    return F.sqrt(F.greatest(F.lit(0.0), sum(_term(n / size, q) for n, q in zip(fold(counts), shares)) / 2))


def _word_distance(q: Column, rest: Column) -> Column:
    """To the common words' shares ``q`` and the other words' share ``rest``. A
    common word that the text lacks adds its reference share."""
    seen = F.transform(F.arrays_zip(F.col("_cats").alias("c"), F.col("_freq").alias("f")), lambda x: F.struct(
        (x["f"] / F.col("_total")).alias("p"), F.get(q, (x["c"] - 1).cast("int")).alias("q")))
    start = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))
    acc = F.aggregate(seen, start, lambda s, x: F.struct(
        (s["d"] + _term(x["p"], x["q"])).alias("d"), (s["p"] + x["p"]).alias("p"), (s["q"] + x["q"]).alias("q")),
        lambda s: s["d"] + _term(F.greatest(F.lit(0.0), 1 - s["p"]), rest) + F.greatest(F.lit(0.0), 1 - rest - s["q"]))
    return F.sqrt(F.greatest(F.lit(0.0), acc / 2))


def _literals(shares: list[float]) -> tuple[Column, Column]:
    return F.array(*[F.lit(float(x)) for x in shares]), F.lit(float(shares[-1]))


def judge(documents: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] | None = None,
          min_words: int = MIN_WORDS) -> DataFrame:
    """The ``keep`` columns (default: all) with the base counts, ``base_failed``
    and ``kept``. Profiles are measured once, into a table in the shared folder."""
    keep = [c for c in (documents.columns if keep is None else keep) if c not in RESULT]
    profiles = cut_lineage(measured(documents, text, [*keep, *([] if lang in keep else [lang])]), "profiles")
    solid, other = references(profiles, lang, min_words)
    slack = 1 / F.sqrt(F.col("n_words").cast("double"))

    def fits(chars: list, words: Column, rest: Column) -> Column:
        return (_char_distance(chars) <= CHAR_LIMIT + CHAR_SLACK * slack) & (
            (F.col("_total") == 0) | (_word_distance(words, rest) <= WORD_LIMIT + WORD_SLACK * slack))

    near = F.lit(True)
    if solid:
        # One row a language: Spark broadcasts it if it is small, else AQE splits a hot language.
        profiles = profiles.join(other, F.col(lang) == F.col("_lang"), "left")
        own = fits([F.get("_ref_chars", F.lit(i)) for i in range(len(CLASSES) + 1)], F.col("_ref_words"),
                   F.get("_ref_words", F.lit(len(COMMON))))
        unknown = F.col(lang).isNotNull() & ~F.col(lang).isin(*solid) & F.col("_lang").isNull()
        classes = [_char_distance(c, _one_alphabet) <= OTHER_LIMIT + CHAR_SLACK * slack for c, _ in solid.values()]
        near = functools.reduce(Column.__or__, [fits(c, *_literals(w)) for c, w in solid.values()])
        near = near | (F.col("_lang").isNotNull() & own) | (unknown & functools.reduce(Column.__or__, classes))
    verdict = F.when(F.col("base_failed"), False).when(F.col("n_words") < min_words, True).otherwise(near)
    return profiles.withColumn("kept", F.coalesce(verdict, F.lit(False))).select(*keep, *RESULT)


def _oracle() -> str:
    """The same in DuckDB, in tables of words, windows and histogram entries."""
    words = ", ".join(f"'{w}'" for w in COMMON)
    counts = ", ".join(f"length(t) - length(regexp_replace(t, '[{c}]', '', 'g'))" for c in (x.replace("'", "''") for x in CLASSES))
    folded = (OTHER_SCRIPTS + 1, len(CLASSES) + 1)  # the letters of all scripts, counted from 1
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{SPACE}'), lambda x: x <> '') AS ws,
        list_filter(regexp_split_to_array(lower(t), '[^\\p{{L}}]+'), lambda x: x <> '') AS pl,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines, [{counts}] AS c FROM d),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
v AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat FROM r, (SELECT unnest([0, 1, 2]) AS j) WHERE n > 1 GROUP BY doc_id),
b AS (SELECT w.doc_id, lang, cast(len(ws) AS bigint) AS n_words, cast(length(array_to_string(ws, '')) AS bigint) AS word_chars,
        c[2] AS n_symbols, cast(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
        len(pl) AS total, list_transform(list_append(c, length(t) - list_sum(c)), lambda x: x / length(t)) AS p
      FROM w LEFT JOIN v ON w.doc_id = v.doc_id),
s AS (SELECT doc_id, word, count(*) / any_value(total) AS p FROM (SELECT doc_id, len(pl) AS total, unnest(pl) AS word FROM w)
      WHERE word IN ({words}) GROUP BY doc_id, word),
u AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
k AS (SELECT lang, count(*) AS n FROM u WHERE NOT base_failed AND lang IS NOT NULL GROUP BY lang),
ks AS (SELECT lang FROM k WHERE n >= {SOLID_SHARE} * (SELECT sum(n) FROM k) OR lang = (SELECT lang FROM k ORDER BY n DESC, lang LIMIT 1)),
h AS (SELECT doc_id, lang, base_failed, unnest(range(1, {len(CLASSES) + 2})) AS i, unnest(p) AS x FROM u WHERE NOT base_failed),
rc AS (SELECT lang, i, avg(x) AS q FROM h WHERE lang IS NOT NULL GROUP BY lang, i),
rw AS (SELECT u.lang, word, sum(s.p) / any_value(k.n) AS q FROM u JOIN s USING (doc_id) JOIN k ON k.lang = u.lang
       WHERE NOT base_failed GROUP BY u.lang, word),
ro AS (SELECT k.lang, greatest(0, 1 - coalesce(sum(q), 0)) AS q FROM k LEFT JOIN rw USING (lang) GROUP BY k.lang),
ff AS (SELECT doc_id, lang, sqrt(greatest(0, sum(CASE WHEN x > 0 THEN x * log2(2 * x / (x + q)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(2 * q / (x + q)) ELSE 0 END) / 2)) AS far
       FROM (SELECT doc_id, CASE WHEN i IN {folded} THEN 0 ELSE i END AS i, sum(x) AS x FROM h GROUP BY ALL)
       JOIN (SELECT lang, CASE WHEN i IN {folded} THEN 0 ELSE i END AS i, sum(q) AS q FROM rc JOIN ks USING (lang) GROUP BY ALL) USING (i)
       GROUP BY doc_id, lang),
fm AS (SELECT doc_id, min(far) AS far FROM ff GROUP BY doc_id),
kw AS (SELECT u.lang FROM u JOIN fm USING (doc_id) WHERE NOT base_failed AND u.lang IS NOT NULL AND u.lang NOT IN (SELECT lang FROM ks)
       GROUP BY u.lang HAVING 2 * count(*) FILTER (WHERE far <= {FAR_LIMIT}) >= count(*)),
m AS (SELECT doc_id, n_words, total, ks.lang AS ref FROM u CROSS JOIN ks WHERE NOT base_failed
      UNION ALL SELECT doc_id, n_words, total, kw.lang FROM u JOIN kw ON kw.lang = u.lang WHERE NOT base_failed),
dc AS (SELECT m.doc_id, ref, sqrt(greatest(0, sum(CASE WHEN x > 0 THEN x * log2(2 * x / (x + q)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(2 * q / (x + q)) ELSE 0 END) / 2)) AS far
       FROM m JOIN h ON h.doc_id = m.doc_id JOIN rc ON rc.lang = m.ref AND rc.i = h.i GROUP BY m.doc_id, ref),
tw AS (SELECT m.doc_id, ref, sum(p * log2(2 * p / (p + coalesce(q, 0))) + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) AS far,
         sum(p) AS p, sum(coalesce(q, 0)) AS q
       FROM m JOIN s ON s.doc_id = m.doc_id LEFT JOIN rw ON rw.lang = ref AND rw.word = s.word GROUP BY m.doc_id, ref),
aw AS (SELECT m.doc_id, m.ref, coalesce(far, 0) AS far, greatest(0, 1 - coalesce(tw.p, 0)) AS x, ro.q AS q,
         greatest(0, 1 - ro.q - coalesce(tw.q, 0)) AS lacks
       FROM m JOIN ro ON ro.lang = m.ref LEFT JOIN tw ON tw.doc_id = m.doc_id AND tw.ref = m.ref),
dw AS (SELECT doc_id, ref, sqrt(greatest(0, far + CASE WHEN x > 0 THEN x * log2(2 * x / (x + q)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(2 * q / (x + q)) ELSE 0 END + lacks) / 2) AS far FROM aw),
f AS (SELECT m.doc_id, bool_or(dc.far <= {CHAR_LIMIT} + {CHAR_SLACK} / sqrt(n_words)
         AND (total = 0 OR dw.far <= {WORD_LIMIT} + {WORD_SLACK} / sqrt(n_words))) AS near
      FROM m JOIN dc ON dc.doc_id = m.doc_id AND dc.ref = m.ref JOIN dw ON dw.doc_id = m.doc_id AND dw.ref = m.ref GROUP BY m.doc_id),
o AS (SELECT u.*, coalesce(near, false) OR (SELECT count(*) FROM k) = 0
        OR (u.lang IS NOT NULL AND u.lang NOT IN (SELECT lang FROM ks) AND u.lang NOT IN (SELECT lang FROM kw)
            AND coalesce(fm.far <= {OTHER_LIMIT} + {CHAR_SLACK} / sqrt(n_words), false)) AS near
      FROM u LEFT JOIN f ON f.doc_id = u.doc_id LEFT JOIN fm ON fm.doc_id = u.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND near AS kept FROM o
"""


@register("op4_quality_rules", _oracle())
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and divergence verdict of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs, keep=["doc_id"])
