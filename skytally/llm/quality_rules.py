"""Quality rules: lines that fail are removed first, then documents that lose too much are rejected."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GAP = r"[\x20\x09-\x0D]+"
#: Code points with the Unicode property Sentence_Terminal, of all scripts, and the ellipsis.
_ENDS = (
    "21 2E 3F 589 61D-61F 6D4 700-702 7F9 837 839 83D 83E 964 965 104A 104B 1362 1367 1368 166E 1735 1736 17D4 17D5 1803 1809 1944 1945 1AA8-1AAB "
    "1B4E 1B4F 1B5A 1B5B 1B5E 1B5F 1B7D-1B7F 1C3B 1C3C 1C7E 1C7F 2024 2026 203C 203D 2047-2049 2CF9-2CFB 2E2E 2E3C 2E53 2E54 2E60 2E61 3002 A4FF "
    "A60E A60F A6F3 A6F7 A876 A877 A8CE A8CF A92F A9C8 A9C9 AA5D-AA5F AAF0 AAF1 ABEB FE12 FE15 FE16 FE52 FE56 FE57 FF01 FF0E FF1F FF61 10A56 "
    "10A57 10F55-10F59 10F86-10F89 11047 11048 110BE-110C1 11141-11143 111C5 111C6 111CD 111DE 111DF 11238 11239 1123B 1123C 112A9 113D4 113D5 "
    "1144B 1144C 115C2 115C3 115C9-115D7 11641 11642 1173C-1173E 11944 11946 11A42 11A43 11A9B 11A9C 11C41 11C42 11EF7 11EF8 11F43 11F44 16A6E "
    "16A6F 16AF5 16B37 16B38 16B44 16D6E 16D6F 16E98 1BC9F 1DA88 "
)
MARKS = "".join(chr(c) for r in _ENDS.split() for a, _, b in [r.partition("-")] for c in range(int(a, 16), int(b or a, 16) + 1))
#: What may stand behind a sentence's mark.
CLOSERS = "\"”»'’)]"
#: Letters of Thai, Lao and Tibetan, whose prose has no such marks.
_MARKLESS = r"[\x{E00}-\x{FFF}]"
#: First character of a line that goes on with a sentence: no capital, and no bullet or sign.
_GOES_ON = r"\A[\x20\x09]*[\p{Ll}\p{Lo}]"
_NAVIGATION = r"\A[|»›•·>/]+\z"
_STRAY = r"[#*$%&<>]\z"
#: Phrases of notices and controls that are no part of a page's prose.
_PHRASES = (
    r"all rights reserved|terms of (use|service)|privacy policy|cookie policy|use of cookies|accept cookies|enable javascript|"
    r"lorem ipsum|click here|sign (in|up) |log in|subscribe to|share this|read more|back to top|powered by"
)
_SIGNS = r"©|\(c\) [12][0-9]{3}"
#: As words of their own: "blog in" and "solar-powered by" are no notices.
_NOTICE = rf"(?<![\p{{L}}\p{{M}}\p{{N}}_]-?)(?:{_PHRASES})(?:(?<=\x20)|s?(?!-?[\p{{L}}\p{{M}}\p{{N}}_]))|{_SIGNS}"


class Rules(NamedTuple):
    """A line fails with ``separators`` or more navigation marks that are at least ``separator_share`` of its words;
    with boilerplate, as whole words, in at most ``notice_words`` words; with no end of a sentence in any script's marks, unless the next line goes on with it,
    or with more than ``end_share`` of its words (8 or more) ending one; with more than ``stray_share`` of its words ending in a stray symbol. A document is rejected when more than ``lost`` of its characters go."""

    separators: int = 2
    separator_share: float = 0.2
    notice_words: int = 40
    end_share: float = 0.5
    stray_share: float = 0.2
    lost: float = 0.3
    wrap_words: int = 5
    min_words: int = 10
    repeat_percent: int = 20


def ends_sentence(word: Column) -> Column:
    """True if a mark stands at the end of the word, before closing quotes and brackets: one look at one character."""
    last = F.right(F.rtrim(word, F.lit(CLOSERS)), F.lit(1))
    return (last != "") & F.contains(F.lit(MARKS), last)


def unfinished(words: Column, following: Column, rules: Rules) -> Column:
    """No word ends a sentence. A line of ``wrap_words`` or more is excused if the line right below starts with a small letter or
    one of a script without capitals (wrapped prose), and so is one whose words are mostly of a script without marks."""
    goes_on = (F.size(words) >= rules.wrap_words) & F.coalesce(following.rlike(_GOES_ON), F.lit(False))
    markless = 2 * F.size(F.filter(words, lambda w: w.rlike(_MARKLESS))) > F.size(words)
    return ~F.exists(words, ends_sentence) & ~goes_on & ~markless


def line_fails(line: Column, following: Column, words: Column, rules: Rules) -> Column:
    n = F.size(words)
    marks = F.size(F.filter(words, lambda w: w.rlike(_NAVIGATION)))
    stray = F.size(F.filter(words, lambda w: w.rlike(_STRAY)))
    shouts = (n >= 8) & (F.size(F.filter(words, ends_sentence)) > rules.end_share * n)
    return (
        (stray > rules.stray_share * n)
        | unfinished(words, following, rules)
        | shouts
        | ((marks >= rules.separators) & (marks >= rules.separator_share * n))
        | ((n <= rules.notice_words) & F.lower(line).rlike(_NOTICE))
    )


def _repeat_words(df: DataFrame) -> DataFrame:
    """n_repeat_words of ``words``: words in 5-word windows that stand twice or more in the text.

    Windows are compared by 64-bit hashes inside one text. Sorted by hash, equal windows are neighbours; their
    positions, sorted, cover 5 words each, less what the next one covers too. Only texts with an equal pair sort.
    """
    df = df.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    gram = lambda i: F.xxhash64(*(F.get("h", i + k) for k in range(5)))
    df = df.withColumn("grams", F.when(F.size("h") >= 5, F.transform(F.sequence(F.lit(0), F.size("h") - 5), gram)).otherwise(F.array().cast("array<long>")))
    pairs = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = df.withColumn("pairs", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), pairs))
    equal = lambda x, i: (x["g"] == F.get("pairs", i - 1)["g"]) | (x["g"] == F.get("pairs", i + 1)["g"])
    df = df.withColumn("at", F.sort_array(F.transform(F.filter("pairs", lambda x, i: F.coalesce(equal(x, i), F.lit(False))), lambda x: x["i"])))
    covers = F.transform("at", lambda x, i: F.least(F.lit(5), F.coalesce(F.get("at", i + 1) - x, F.lit(5))))
    n = F.aggregate(covers, F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(n, F.lit(0).cast("long"))).drop("h", "grams", "pairs", "at")


def clean_lines(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the counts, base_failed, lost, kept and text (its lines that pass) of each row of ``docs`` (doc_id, text).

    n_words words ``[^\\x20\\x09-\\x0D]+``; word_chars their code points; n_symbols characters of ``#*$%&|<>``;
    n_dup_lines lines with a word that equal an earlier line; n_repeat_words see ``_repeat_words``. base_failed:
    under ``min_words`` words, or more than ``repeat_percent`` per cent repeated. lost: share of the characters of
    the lines with a word that fail; the line below one is the next of the text, also an empty one. Null and empty text: no words, base_failed, not kept; null stays null. Rows are
    independent: repeated rows agree, an empty table gives an empty result. Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    df = docs.select("doc_id", "text", F.array_remove(F.split(text, _GAP), "").alias("words"), F.split(text, "\n").alias("all"))
    df = df.withColumn("below", F.filter(F.transform("all", lambda x, i: F.struct(x.alias("l"), F.get("all", i + 1).alias("below"))), lambda x: x["l"].rlike(r"[^\x20\x09-\x0D]"))).drop("all")
    df = df.withColumns({"lines": F.transform("below", lambda x: x["l"]), "of_lines": F.transform("below", lambda x: F.array_remove(F.split(x["l"], _GAP), ""))})
    df = df.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.coalesce(F.regexp_count("text", F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "good": F.filter("lines", lambda x, i: ~line_fails(x, F.get("below", i)["below"], F.get("of_lines", i), rules)),
    })
    df = _repeat_words(df).drop("words")
    size = lambda c: F.length(F.array_join(c, ""))
    df = df.withColumn("lost", F.coalesce(1 - F.try_divide(size("good"), size("lines")), F.lit(0.0)))
    df = df.withColumn("base_failed", (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words")))
    kept = ~F.col("base_failed") & (F.col("lost") <= rules.lost)
    out = F.when(F.col("text").isNotNull(), F.array_join("good", "\n"))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost", kept.alias("kept"), out.alias("text"))
