"""Text functions as column expressions; everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The vocabulary tokeniser's pattern and stop words.
TOKEN = "[a-z][a-z0-9]{2,}"
STOP_WORDS = (
    "the and for are was were with that this from have has had not but which their these those been also can may such than they "
    "our its into between using used use both each more most other results study studies showed shown however therefore"
).split()

# Section kinds, first hit wins.
SECTION_KINDS = [
    ("methods", ["method", "materials and methods", "experimental", "procedure", "data collection", "statistical analys", "study design"]),
    ("results", ["result", "findings"]),
    ("discussion", ["discussion"]),
    ("conclusion", ["conclusion", "concluding", "summary"]),
    ("introduction", ["introduction", "background"]),
    ("related", ["related work", "literature review", "prior work"]),
    ("limitations", ["limitation"]),
]

# Name parts that are salts, stereo descriptors, or too common to be a drug.
SALTS = (
    "hydrochloride hcl hydrobromide sulfate sulphate bitartrate tartrate citrate maleate mesylate besylate fumarate phosphate acetate succinate "
    "hydrate dihydrate monohydrate sodium potassium calcium bromide chloride nitrate polacrilex anhydrous base pamoate decanoate valerate"
).split()
STEREO = "r s rs sr rac racemic d l dl ld cis trans levo dextro es ar ent".split()
COMMON_SUBSTANCES = "water oxygen alcohol glucose saline placebo control nitrogen carbon starch sucrose lactose glycerol dextrose".split()
# Words that name no protein by themselves.
GENERIC_PROTEIN_WORDS = (
    "receptor protein factor kinase enzyme subunit channel transporter alpha beta gamma delta type human chain domain family like putative isoform precursor binding"
).split()

_SPACE = r"(?U)[\s\x1c-\x1f]+"
SENTENCE_END = r"(?<=[.!?])\s+(?=[A-Z0-9(\"'])"


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def words(text: Column) -> Column:
    """Words between white space of any kind; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def sentence_count(text: Column) -> Column:
    """Sentences end at . ! ? before white space and a capital, digit, quote or bracket; an empty text is one sentence."""
    return F.size(F.split(F.coalesce(text, F.lit("")), SENTENCE_END))


def tokens(text: Column) -> Column:
    """Index terms: lower case, three characters or more, no stop words."""
    return F.filter(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0)), lambda t: ~F.array_contains(_strings(STOP_WORDS), t))


def section_kind(sec_type: Column, sec_title: Column) -> Column:
    title = F.lower(F.coalesce(sec_title, F.lit("")))
    kind = F.when(sec_type.isin("title", "abstract"), sec_type)
    for name, keys in SECTION_KINDS:
        hit = F.lit(False)
        for key in keys:
            hit = hit | title.contains(key)
        kind = kind.when(hit, F.lit(name))
    return kind.otherwise("body")


def letter_ratio(text: Column) -> Column:
    """Letters among the characters that are no white space; 1 where there are none."""
    text = F.coalesce(text, F.lit(""))
    letters, solid = F.length(F.regexp_replace(text, r"[^\p{L}]", "")), F.length(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]", ""))
    return F.coalesce(F.try_divide(letters, solid), F.lit(1.0))


def repeat_ratio(text: Column, least: int = 20) -> Column:
    """Share of the most frequent word; 0 below ``least`` words. Sorted words, so that runs are counted in one pass."""
    w = F.array_sort(words(text))
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("top"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(x == s["last"], s["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["top"], run).alias("top"))

    top = F.aggregate(w, start, step, lambda s: s["top"])
    return F.when(F.size(w) < least, 0.0).otherwise(F.try_divide(top, F.size(w)))


def fixed_chunks(word_list: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` words, ``overlap`` shared; the window that reaches the end is the last. No words: no windows."""
    step = max(1, size - overlap)
    n = F.size(word_list)
    last = F.greatest(F.ceil((n - size) / F.lit(step)), F.lit(0)).cast("int")
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(word_list, i * step + 1, size))
    return F.when(n > 0, windows).otherwise(F.array().cast("array<array<string>>"))


def runs(text: Column) -> Column:
    """Maximal runs of a-z of the lower-case text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0))


def _allowed(word: Column) -> Column:
    return F.when((F.length(word) >= 5) & ~word.isin(COMMON_SUBSTANCES), word)


def drug_norm(name: Column) -> Column:
    """Base name of a drug: its first run that is no salt and no stereo descriptor; null below five letters or for common substances."""
    parts = runs(name)
    base = F.filter(parts, lambda t: ~F.array_contains(_strings(SALTS + STEREO), t))
    return _allowed(F.coalesce(F.get(base, F.lit(0)), F.get(parts, F.lit(0))))


def drug_term(name: Column) -> Column:
    """A name to search for, if it is one run of a-z."""
    parts = runs(name)
    return F.when(F.size(parts) == 1, _allowed(F.get(parts, F.lit(0))))


def letter_pattern(term: Column) -> Column:
    """The term between characters that are no letters."""
    return F.concat(F.lit("(^|[^a-z])"), term, F.lit("([^a-z]|$)"))


def name_pattern(term: Column) -> Column:
    """The words of the term, any separators between, between characters that are neither letter nor digit."""
    return F.concat(F.lit("(^|[^a-z0-9])"), F.replace(term, F.lit(" "), F.lit("[^a-z0-9]+")), F.lit("([^a-z0-9]|$)"))


def protein_terms(gene: Column, aliases: Column) -> Column:
    """Distinct search terms of a protein from its gene symbol and its ;-separated aliases: specific words and word sequences."""
    every = F.concat(F.array(F.coalesce(gene, F.lit(""))), F.split(F.coalesce(aliases, F.lit("")), ";"))
    lists = F.transform(every, lambda a: F.regexp_extract_all(F.lower(a), F.lit("[a-z0-9]+"), F.lit(0)))
    generic, symbol = _strings(GENERIC_PROTEIN_WORDS), F.lower(F.coalesce(gene, F.lit("")))
    telling = lambda t: (F.length(t) >= 4) & ~F.array_contains(generic, t)
    alone = lambda t: telling(t) | ((t == symbol) & (F.length(t) >= 3))
    good = F.filter(lists, lambda p: F.when(F.size(p) == 1, alone(F.get(p, F.lit(0)))).otherwise(F.exists(p, telling)))
    return F.array_distinct(F.transform(good, lambda p: F.concat_ws(" ", p)))


def snippet(text: Column, term: str, before: int = 60, after: int = 120) -> Column:
    """The text around the first occurrence of the term, on one line."""
    at = F.locate(term.lower(), F.lower(text)) - 1
    start = F.greatest(at - before, F.lit(0))
    return F.regexp_replace(F.substring(text, start + 1, at + after - start), r"\n", " ")


def inverted_to_text(index: Column) -> Column:
    """Words at their positions: map<string, array<int>> to running text; an empty or null map gives null."""
    spread = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda i: F.struct(i.alias("at"), e["key"].alias("word")))))
    return F.nullif(F.concat_ws(" ", F.transform(F.array_sort(spread), lambda x: x["word"])), F.lit(""))
