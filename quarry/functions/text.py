"""Text column functions (T1-T15, T17, T21). All JVM-side expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry import params

# The cleaning patterns of the normalisation chain.
EMAIL_RE = r"\b[\w\.-]+@[\w\.-]+\.\w+\b"
URL_RE = r"https?://\S+|www\.\S+"
CONTROL_RE = r"[\x00-\x1f\x7f-\x9f]"
NON_WORD_RE = r"[^\w\s\.,!?'\"\-]"
NON_ASCII_RE = r"[^\x00-\x7f]"
TOKEN_RE = r"\b[a-z_]+\b"
LEMMA_TOKEN_RE = r"\w+|[^\w\s]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_emails(c) -> Column:                     # T1
    return F.regexp_replace(_c(c), EMAIL_RE, "")


def remove_urls(c) -> Column:                       # T2
    return F.regexp_replace(_c(c), URL_RE, "")


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Accent-folding table derived from Unicode NFKD over all code points:
    single-character results go into a ``translate`` map, multi-character ones
    into a replace map. Everything still non-ASCII afterwards is dropped (as an
    ASCII encode with errors ignored would)."""
    src, dst, multi = [], [], []
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if not unicodedata.decomposition(ch):
            continue
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif len(folded) > 1:
            multi.append((ch, folded))
    return "".join(src), "".join(dst), tuple(multi)


def fold_accents(c) -> Column:                      # T3
    """NFKD + drop non-ASCII, as a JVM expression (no Python UDF)."""
    src, dst, multi = _fold_table()
    given = _c(c)
    col = F.translate(given, src, dst)
    table = F.create_map(*[F.lit(x) for pair in multi for x in pair])
    letters = F.transform(F.regexp_extract_all(col, F.lit("(?s)."), 0), lambda x: F.coalesce(F.try_element_at(table, x), x))
    # the multi-character replacements only run on the rare rows that need them
    col = F.when(col.rlike("[" + "".join(ch for ch, _ in multi) + "]"), F.concat_ws("", letters)).otherwise(col)
    # plain ASCII, most texts, is looked at once and left alone
    return F.when(given.rlike(NON_ASCII_RE), F.regexp_replace(col, NON_ASCII_RE, "")).otherwise(given)


def remove_control(c, replacement: str = "") -> Column:   # T4 (Q18: default joins words)
    return F.regexp_replace(_c(c), CONTROL_RE, replacement)


def keep_word_chars(c) -> Column:                   # T5
    return F.regexp_replace(_c(c), NON_WORD_RE, "")


def collapse_ws(c) -> Column:                       # T6
    return F.trim(F.regexp_replace(_c(c), r"\s+", " "))


def normalize_text(c, legacy: bool = False, symbols: list[tuple[str, str]] | None = None,
                   lemmas: list[tuple[str, str]] | None = None) -> Column:     # T7
    """Full cleaning chain in the reference order: symbols to names, e-mails,
    URLs, accents, control characters, other signs, white space, lemmas. Symbol
    and lemma tables are the caller's; without one its step is left out.
    ``legacy`` skips the e-mail / URL steps and both tables like the older variant."""
    col = _c(c)
    if not legacy:
        col = remove_urls(remove_emails(replace_table(col, symbols or [])))
    col = fold_accents(col)
    col = remove_control(col)
    col = keep_word_chars(col)
    col = collapse_ws(col)
    return lemmatize_text(col, lemmas) if lemmas and not legacy else col


def replace_aliases(c, lookup: list[tuple[str, str]] | None = None) -> Column:  # T10
    """Lower-case, then replace each alias (word-bounded) by its canonical
    token, one regex per alias in dictionary order (Q5 reproduced)."""
    lookup = params.alias_lookup() if lookup is None else lookup
    col = F.lower(_c(c))
    for alias, canon in lookup:
        col = F.regexp_replace(col, r"\b" + re.escape(alias) + r"\b", canon.replace("\\", "\\\\").replace("$", "\\$"))
    return col


def tokenize(c, stop_words: list[str] | None = None, min_len: int = 3) -> Column:  # T11
    """``[a-z_]+`` word tokens of the lower-cased text, minus stop words and
    tokens shorter than ``min_len``."""
    stop = F.array(*[F.lit(w) for w in (params.STOP_WORDS if stop_words is None else stop_words)])
    toks = F.regexp_extract_all(F.lower(_c(c)), F.lit(TOKEN_RE), 0)
    return F.filter(toks, lambda t: (F.length(t) >= min_len) & ~F.array_contains(stop, t))


def ngrams(tokens, n_max: int = 2, n_min: int = 1, sep: str = "_") -> Column:  # T12
    """All n-grams for n in [n_min, n_max], unigrams first, each in text order."""
    toks = _c(tokens)
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(toks)
            continue
        idx = F.sequence(F.lit(1), F.size(toks) - n + 1)
        parts.append(F.when(F.size(toks) >= n,
                            F.transform(idx, lambda i: F.array_join(F.slice(toks, i, n), sep)))
                     .otherwise(F.array().cast("array<string>")))
    return reduce(lambda a, b: F.concat(a, b), parts)


def slug(c) -> Column:                              # T14
    return F.replace(F.lower(_c(c)), F.lit(" "), F.lit("_"))


def polarity_label(score, threshold: float = params.SENTIMENT_THRESHOLD) -> Column:  # T17
    s = _c(score)
    return (F.when(s >= threshold, "positive")
            .when(s <= -threshold, "negative")
            .otherwise("neutral"))


def rnd(c, places: int = 6) -> Column:              # T21
    return F.bround(_c(c), places)


def explode_nonempty(df, array_col: str, alias: str, *keep: str):
    """``explode`` via ``explode_outer`` + null filter. A plain explode makes
    the optimizer infer ``size(arr) > 0`` and push it below, which would
    re-evaluate the whole array expression (tokenizer, n-gram lambdas) at
    the scan."""
    return (df.select(*keep, F.explode_outer(array_col).alias(alias))
              .filter(F.col(alias).isNotNull()))


def mean_e4(c) -> Column:
    """Exact mean of a column holding 4-decimal values: integer sum, one
    division. Bit-identical across partitionings (and across engines)."""
    c = _c(c)
    return F.sum(F.round(c * 10000).cast("long")).cast("double") / F.count(c) / F.lit(10000.0)


def ratio_half_even(total: Column, n: Column) -> Column:
    """The whole number nearest to total / n (n > 0), a half to the even
    one, in integer arithmetic."""
    rest = F.pmod(total, n)
    low = F.floor((total - rest) / n).cast("long")
    up = (2 * rest > n) | ((2 * rest == n) & (F.pmod(low, F.lit(2)) == 1))
    return low + up.cast("long")


def round_doubles(df, places: int = 6):
    """T21 for result tables: round every double column (float sums are
    partition-order dependent in the last bits)."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])


def replace_table(c, pairs: list[tuple[str, str]]) -> Column:
    """T8 (re-aimed demojize): replace every listed symbol by its name,
    from a caller-supplied (symbol, name) table."""
    col = _c(c)
    for sym, name in pairs:
        col = F.replace(col, F.lit(sym), F.lit(name))
    return col


def lemmatize_text(c, lemmas: list[tuple[str, str]]) -> Column:
    """T9 on a text: words and single punctuation marks, each word by its lemma
    (looked up in lower case; other words stay as they are), joined by a space."""
    parts = F.regexp_extract_all(_c(c), F.lit(LEMMA_TOKEN_RE), 0)
    m = F.create_map(*[F.lit(x) for pair in lemmas for x in pair])
    return F.array_join(F.transform(parts, lambda w: F.coalesce(F.try_element_at(m, F.lower(w)), w)), " ")


def lemmatize_tokens(tokens, lemmas: list[tuple[str, str]]) -> Column:
    """T9 (re-aimed lemmatiser): map each token through a caller-supplied
    (form, lemma) table compiled into a literal map; unknown forms stay."""
    m = F.create_map(*[x for a, b in lemmas for x in (F.lit(a), F.lit(b))]) if lemmas else None
    t = _c(tokens)
    if m is None:
        return t
    return F.transform(t, lambda w: F.coalesce(F.try_element_at(m, w), w))


def alpha_tokens(c, min_len: int = 1, strip_punct: bool = False, exclude: list[str] | None = None) -> Column:
    """Whitespace tokens, alphabetic only (or punctuation-stripped),
    lower-cased, at least ``min_len`` chars, minus ``exclude``."""
    toks = F.split(F.lower(_c(c)), " ")
    if strip_punct:
        toks = F.transform(toks, lambda w: F.regexp_replace(w, r"[^\w]", ""))
        keep = lambda w: F.length(w) >= min_len
    else:
        keep = lambda w: w.rlike("^[a-z]+$") & (F.length(w) >= min_len)
    ex = F.array(*[F.lit(x) for x in (exclude or [])]) if exclude else None
    return F.filter(toks, (lambda w: keep(w) & ~F.array_contains(ex, w)) if ex is not None else keep)
