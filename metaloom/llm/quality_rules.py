"""Rules of quality: a table of thresholds compiled into one projection, evaluated without user functions.

A rule names a ratio and the least and the greatest value it may have. Words, lines and windows are read
off a text once, behind generators of one row, so no ratio writes the splitting out again; everything else
is columns. Windows of eight words are told apart by 64 bits (chained hashes of their words), so two
different windows of one text are taken for one with a chance of about 1e-7 in a text of a million words.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import ascii_lower
from metaloom.operators.computed import computed

WINDOW = 8
SYMBOLS = "#*$%&|<>"
_SPACES = "\t\n\x0b\x0c\r"
# Marks that cling to a word; a stop word is looked up without them.
_MARKS = ".,;:!?()\"'"

# Frequent words of the languages the corpus is written in.
STOP_WORDS = ("the of and to in a is that for with on as was it by be are this from at or an not have "
              "le la les de des et en un une que qui dans pour est sur au aux du par "
              "der die das und zu den von mit ist des im für auf ein eine nicht "
              "el los y con para se del las es al por su").split()


class Rule(NamedTuple):
    """A measure, as a share of another where `of` is given, must lie in [low, high]."""

    name: str
    measure: str
    of: str | None = None
    low: float | None = None
    high: float | None = None


# Length, symbol, stop-word and line ratios. Shares are of words or of lines that hold a word.
RULES = [
    Rule("few_words", "n_words", low=20),
    Rule("short_or_long_words", "word_chars", "n_words", low=2, high=12),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("few_stop_words", "n_stop_words", "n_words", low=0.01),
    Rule("echoed_words", "n_echoed_words", "n_words", high=0.2),
    Rule("repeated_windows", "n_repeat_words", "n_words", high=0.3),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("bullets", "n_bullet_lines", "n_lines", high=0.9),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=0.3),
]

MEASURES = ["n_words", "word_chars", "n_symbols", "n_stop_words", "n_echoed_words", "n_repeat_words",
            "n_lines", "n_dup_lines", "n_bullet_lines", "n_cut_lines"]


def words_of(text):
    """The words of a text that is not null."""
    return F.array_remove(F.split(F.translate(text, _SPACES, " " * len(_SPACES)), " "), "")


def _repeat_words(sorted_windows):
    """Words that lie in a window found twice or more; neighbours in the sorted windows are compared."""
    def hash_at(i):
        return F.try_element_at(sorted_windows, i)["h"]

    repeated = F.sort_array(F.transform(F.filter(
        sorted_windows, lambda x, i: (x["h"] == F.when(i > 0, hash_at(i))) | (x["h"] == hash_at(i + 2))),
        lambda x: x["p"]))
    # Starts in order: a window adds the words that the one before it does not cover, the first all of its own.
    covered = F.aggregate(
        repeated, F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")),
        lambda s, p: F.struct((s["sum"] + F.least(F.lit(WINDOW), p - s["last"])).alias("sum"), p.alias("last")),
        lambda s: s["sum"])
    return F.when(F.size(repeated) > 0, covered).otherwise(0)


def measured(docs: DataFrame, text_col="text") -> DataFrame:
    """`docs` and the measures, whole texts read, null as empty; columns of these names are replaced."""
    docs = docs.select([c for c in docs.columns if c not in MEASURES])
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = F.translate(ascii_lower(text), _MARKS + _SPACES, " " * len(_MARKS + _SPACES))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, _SPACES, " " * len(_SPACES))) != "")
    rows = computed(docs, _words=words_of(text), _plain=F.split(plain, " "), _lines=lines)
    rows = computed(rows, _hashes=F.transform("_words", lambda w: F.xxhash64(w)))
    starts = F.when(F.size("_words") >= WINDOW, F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    rows = computed(rows, _windows=F.transform(starts, lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW))))
    # Most texts repeat no window; only those that do are sorted.
    marked = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), (i + 1).alias("p")))
    rows = computed(rows, _sorted=F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(marked)))
    bullet = ("- ", "* ", "•", "‣", "◦")
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.translate(text, " " + _SPACES, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_stop_words": F.size(F.filter("_plain", lambda w: w.isin(STOP_WORDS))),
        "n_echoed_words": F.size(F.filter("_hashes", lambda h, i: h == F.when(i > 0, F.try_element_at("_hashes", i)))),
        "n_repeat_words": F.when(F.col("_sorted").isNull(), 0).otherwise(_repeat_words(F.col("_sorted"))),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_bullet_lines": F.size(F.filter("_lines", lambda x: F.greatest(*[F.startswith(F.ltrim(x), F.lit(b)) for b in bullet]))),
        "n_cut_lines": F.size(F.filter("_lines", lambda x: F.endswith(F.rtrim(x), F.lit("...")) | F.endswith(F.rtrim(x), F.lit("…")))),
    }
    found = computed(rows, **{name: measures[name].cast("long") for name in MEASURES})
    return found.drop("_words", "_plain", "_lines", "_hashes", "_windows", "_sorted")


def compiled(rules=RULES):
    """The rules as one column: the names of those a row fails, in the order of the table. A measure that
    is null (a share of nothing) fails no rule."""
    def failed(rule):
        value = F.col(rule.measure) if rule.of is None else F.try_divide(rule.measure, rule.of)
        return F.coalesce((value < rule.low if rule.low is not None else F.lit(False))
                          | (value > rule.high if rule.high is not None else F.lit(False)), F.lit(False))

    return F.array_compact(F.array(*[F.when(failed(rule), F.lit(rule.name)) for rule in rules]))


def judge(docs: DataFrame, text_col="text", rules=RULES) -> DataFrame:
    """`docs`, the measures, `failed_rules` and `kept`; one row per input row.

    A null or empty text has no words and fails the rules of length. Rows that repeat are judged alike;
    ids are not looked at. Columns called like a measure, `failed_rules` or `kept` are replaced. An empty table gives no
    rows; an empty table of rules keeps all.
    """
    rows = measured(docs, text_col).drop("failed_rules", "kept")
    failed = compiled(rules) if rules else F.array().cast("array<string>")
    return computed(rows, failed_rules=failed).withColumn("kept", F.size("failed_rules") == 0)
