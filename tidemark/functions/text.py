"""Text rules: classifiers, titles, counts, punctuation and glyph hygiene."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Note keywords, credit tokens, wordmark, commit types, glyphs.
NOTE_WORDS = {
    "needs_none": ("no watermark or defect present", "did not need cleaning"),
    "wrong_edit": ("contextually incorrect",),
    "engine_swap": ("swap lama erase", "block-sdxl rejected", "redo via dekel"),
}
CREDIT_TOKENS = (
    ".com", ".net", ".org", ".io", "www", "http", "://",
    "artstation", "deviantart", "uhdpaper", "patreon", "pixiv",
    "instagram", "behance", "twitter", "wallhaven",
)
CREDIT_LITERALS = (".COM", "WWW", "PATREON", "DEVIANT")
CREDIT_HOSTS = ("DEVIANTART", "PATREON", "ARTSTATION", "BEHANCE")
HANDLE = r"@[A-Za-z0-9_]{2,}"
KEEP_TARGET = "LEAGUEOFLEGENDS"
KEEP_WORDS = ("LEGENDS", "LEAGUE")
COMMIT_TYPES = ("feat", "fix", "docs", "style", "refactor", "perf", "test", "build", "ci", "chore", "revert")
SKIP_PREFIXES = ("Merge ", "Revert ", "Reapply ", "fixup!", "squash!", "amend!")
SUMMARY = r"[0-9]+\s+(?:passed|failed|error|errors|skipped|xfailed|xpassed|deselected|warnings?)"
MOJIBAKE_A = "\u00e2\u201d\u20ac"
MOJIBAKE_B = "\u00e2\u20ac\u201d"
PUNCTUATION = {
    "\u201c": '"',
    "\u2018": "'",
    "\u2019": "'",
    "\u2013": " - ",
    "\u2014": " - ",
    "\u2026": "...",
    "\u00a0": " ",
}
GLYPHS = {
    "em-dash": "\u2014",
    "en-dash": "\u2013",
    "smart-dquote-open": "\u201c",
    "smart-dquote-close": "\u201d",
    "smart-quote-open": "\u2018",
    "smart-quote-close": "\u2019",
}
RULE_GLYPH = "\u2500"


def classify_note(note: Column, words: dict[str, tuple[str, ...]] = NOTE_WORDS) -> Column:
    """First word list with a hit names the note."""
    low = F.lower(F.coalesce(note, F.lit("")))
    ladder = F
    for label, needles in words.items():
        hit = low.contains(needles[0])
        for n in needles[1:]:
            hit = hit | low.contains(n)
        ladder = ladder.when(hit, label)
    return ladder.otherwise("other")


def credit_exact(texts: Column) -> Column:
    """Credit text by tokens, literals or an @handle; array of strings in, boolean out."""
    low = F.lower(F.array_join(F.transform(texts, lambda x: F.coalesce(x, F.lit("None"))), " "))

    def found(text: Column) -> Column:
        # Plain substrings one by one are quicker than one pattern of all of them.
        hit = F.contains(text, F.lit("@")) & text.rlike(HANDLE)
        for literal in (*CREDIT_TOKENS, *(t.lower() for t in CREDIT_LITERALS)):
            hit = hit | F.contains(text, F.lit(literal))
        return hit

    return F.exists(F.array(low), found)  # as a lambda's argument the lowered text is made once


# Settings that turn hooks off, and what a hook says when it rejects.
BYPASS_ENV = r"(?i)\b(HUSKY=0|HUSKY_SKIP_HOOKS=1|NO_VERIFY=1|SKIP=)"
HOOK_REJECTION = r"(?i)(precommit_gate\s+BLOCKED|pre-commit|pre-push|commit-msg|husky|lint-staged|hook\s+(failed|rejected|blocked))"


def command_tokens(command: Column) -> Column:
    """Words of a command line; quoted blanks don't part a word, unless a quote is left open."""
    quotes = F.length(command) - F.length(F.translate(command, "\"'", ""))
    whole = F.regexp_extract_all(command, F.lit(r"((?:\"[^\"]*\"|'[^']*'|[^\s\"'])+)"), F.lit(1))
    return F.when(quotes % 2 == 0, whole).otherwise(F.filter(F.split(command, r"\s+"), lambda w: w != ""))


def commit_bypass(command: Column) -> Column:
    """A commit with hooks off, by setting or by flag. The word after ``git`` must be ``commit``: a dry run of a push is none."""
    words = command_tokens(F.lower(command))
    verb = F.get(words, F.array_position(words, "git").cast("int"))
    flags = F.arrays_overlap(words, F.array(F.lit("--no-verify"), F.lit("-n")))
    return F.coalesce(command.rlike(BYPASS_ENV), F.lit(False)) | F.coalesce(F.array_contains(words, "git") & (verb == "commit") & flags, F.lit(False))


def hook_rejected(output: Column) -> Column:
    return F.coalesce(output.rlike(HOOK_REJECTION), F.lit(False))


def norm_token(s: Column) -> Column:
    """Upper case, letters and digits only."""
    return F.regexp_replace(F.upper(s), r"[^\p{L}\p{N}]", "")


@F.pandas_udf(T.DoubleType())
def fuzzy_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block similarity, null where a side is null; no built-in function computes it."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype=float)


def best_ratio(words: tuple[str, ...], floor: float):
    """Best similarity of a string to a few short words; 0 where no word can reach ``floor``.

    Marked as non-deterministic so that the optimizer leaves it after the
    de-duplication it is placed behind.
    """

    @F.pandas_udf(T.DoubleType())
    def best(a: pd.Series) -> pd.Series:
        matchers = [(SequenceMatcher(None, "", w), len(w)) for w in words]

        def top(x):
            score = 0.0
            for m, n in matchers:
                # the lengths and then the shared letters bound the similarity from above
                if x and 2.0 * min(len(x), n) / (len(x) + n) >= floor:
                    m.set_seq1(x)
                    if m.quick_ratio() >= floor:
                        score = max(score, m.ratio())
            return score

        return a.map(top)

    return best.asNondeterministic()


def commit_type(subject: Column) -> Column:
    kind = F.lower(F.regexp_extract(subject, r"^([A-Za-z]+)(?:\([^)]*\))?:", 1))
    return F.when(kind != "", kind).when(F.lower(subject).startswith("merge "), "merge").otherwise("other")


def commit_problem(subject: Column) -> Column:
    """Why a subject is refused; null when it is fine."""
    pattern = rf"^(?:{'|'.join(COMMIT_TYPES)})(?:\([A-Za-z0-9_./\- ]+\))?!?:\s+\S"
    skip = "^(?:" + "|".join(re.escape(p) for p in SKIP_PREFIXES) + ")"
    return (
        F.when(F.trim(subject) == "", "empty subject line")
        .when(subject.rlike(skip) | subject.rlike(pattern), None)
        .otherwise("subject does not match <type>(<scope>)?: <description>")
    )


def first_line(body: Column) -> Column:
    """The first line with content, without its heading marks; null if there is none."""
    plain = F.transform(F.split(body, "\n"), lambda s: F.trim(F.regexp_replace(F.trim(s), "^#+", "")))
    return F.get(F.filter(plain, lambda s: s != ""), F.lit(0))


def short_title(body: Column, limit: int = 160) -> Column:
    """THEME / SCOPE lines joined, else the first line with content."""
    theme = F.trim(F.regexp_extract(body, r"(?im)^[ \t]*THEME:([^\n]*)$", 1))
    scope = F.trim(F.regexp_extract(body, r"(?im)^[ \t]*SCOPE:([^\n]*)$", 1))
    both = F.regexp_replace(F.concat(theme, F.lit(" - "), scope), "^[ -]+|[ -]+$", "")
    return F.coalesce(
        F.when((theme != "") | (scope != ""), F.substring(both, 1, limit)),
        F.substring(first_line(body), 1, limit),
        F.lit("(empty)"),
    )


def shortened(line: Column, limit: int = 140) -> Column:
    """Whole if it fits, else cut with an ellipsis."""
    return F.when(F.length(line) <= limit, line).otherwise(F.concat(F.rtrim(F.substring(line, 1, limit)), F.lit("...")))


def clip(title: Column, limit: int = 140) -> Column:
    """Collapsed, cut before a commit note, shortened with an ellipsis."""
    flat = F.regexp_replace(F.trim(F.regexp_replace(title, r"\s+", " ")), r"^\*+|\*+$", "")
    return shortened(F.regexp_replace(flat, r"(?s)\s*\(commit.*$", ""), limit)


def parse_counts(text: Column) -> Column:
    """Struct(passed, failed, errors, skipped, no_tests) of the last summary line; null when absent."""
    lines = F.filter(
        F.split(text, "\n"), lambda s: s.rlike(SUMMARY) & (F.contains(s, F.lit(" in ")) | F.contains(s, F.lit("=")))
    )
    line = F.when(F.size(lines) > 0, F.element_at(lines, -1))

    def hits(label):
        found = F.regexp_extract_all(line, F.lit(rf"([0-9]+)\s+{label}"), F.lit(1))
        return F.transform(found, lambda n: n.try_cast("long"))

    def final(label):
        return F.when(F.size(hits(label)) > 0, F.element_at(hits(label), -1))

    errors = hits("errors?")
    return F.struct(
        final("passed").alias("passed"),
        final("failed").alias("failed"),
        F.when(F.size(errors) > 0, F.aggregate(errors, F.lit(0).cast("long"), lambda a, n: a + n)).alias("errors"),
        final("skipped").alias("skipped"),
        F.contains(text, F.lit("no tests ran")).alias("no_tests"),
    )


def mentions(text: Column, token: Column) -> Column:
    """Whole-token mention, letters and digits as the boundary, case ignored."""
    quoted = F.concat(F.lit(r"(?<![0-9a-z])\Q"), F.lower(token), F.lit(r"\E(?![0-9a-z])"))
    return F.coalesce((token != "") & F.rlike(F.lower(text), quoted), F.lit(False))


def count_of(text: Column, piece: str) -> Column:
    """Non-overlapping occurrences."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))) / len(piece)).cast("long")


def repair_mojibake(text: Column) -> Column:
    """Struct(text, variant_a, variant_b): both broken forms become an em dash."""
    fixed = F.replace(F.replace(text, F.lit(MOJIBAKE_A), F.lit("\u2014")), F.lit(MOJIBAKE_B), F.lit("\u2014"))
    return F.struct(
        fixed.alias("text"), count_of(text, MOJIBAKE_A).alias("variant_a"), count_of(text, MOJIBAKE_B).alias("variant_b")
    )


def ascii_punct(text: Column, dash: str = " - ") -> Column:
    """Smart punctuation to ASCII; a right quote beside a euro sign is broken text and stays."""
    out = F.regexp_replace(text, "(?<!\u20ac)\u201d(?!\u20ac)", '"')
    for glyph, plain in PUNCTUATION.items():
        out = F.replace(out, F.lit(glyph), F.lit(dash if plain == " - " else plain))
    return out


def ascii_rule(text: Column) -> Column:
    """Struct(text, pre, post, status) of the box-drawing rule replacement."""
    fixed = F.replace(text, F.lit(RULE_GLYPH), F.lit("-"))
    pre, post = count_of(text, RULE_GLYPH), count_of(fixed, RULE_GLYPH)
    status = F.when(pre == 0, "no-hits").when(post != 0, "ascii-mismatch").otherwise("rewritten")
    return F.struct(fixed.alias("text"), pre.alias("pre"), post.alias("post"), status.alias("status"))


def glyph_hits(text: Column, glyphs: dict[str, str] = GLYPHS) -> Column:
    """Sorted names of the watched glyphs present."""
    return F.array_sort(
        F.filter(
            F.array(*[F.when(F.contains(text, F.lit(g)), F.lit(n)) for n, g in glyphs.items()]), lambda x: x.isNotNull()
        )
    )
