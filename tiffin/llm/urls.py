"""URL filter: host and path rules before a weighted vocabulary.

Rules decide first: of the rules that fit, the longest.  Where none fits, an
Aho-Corasick automaton finds every vocabulary term in the lower-cased url,
whose percent escapes of ASCII characters are undone once; a find counts if no
letter or digit adjoins it.  Names of hosts run words together, so terms that
begin or end no ordinary word count in the host with one free side.  One
strict term or ``soft_limit`` distinct soft terms block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Default vocabulary, (strict terms, soft terms), English and what other languages write in Latin letters.
STRICT = ("adult", "escort", "escortes", "hentai", "incest", "nsfw", "phishing", "porn", "porno", "pornografia",
          "sexfilme", "sexkontakte", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "apostas", "apuestas", "bet", "bets", "betting", "bonus", "casino", "cheap", "cialis", "crack", "dating",
        "erotica", "erotik", "erotique", "farm", "free", "gambling", "girls", "glucksspiel", "gokken", "gratis", "gratuit",
        "hazard", "hot", "jackpot", "kasino", "kazino", "keygen", "kredit", "levitra", "loan", "loans", "paris-sportifs",
        "payday", "pharmacy", "pills", "poker", "prestamos", "scommesse", "seks", "sex", "sexe", "sexo", "sexy", "slots",
        "sportwetten", "torrent", "track", "tragaperras", "wetten", "win")
#: Of these, terms that count in a host with one free side.
IN_HOST = ("casino", "gambling", "hentai", "jackpot", "kasino", "kazino", "poker", "porn", "porno", "scommesse",
           "sportwetten", "viagra", "warez")
SOFT_LIMIT = 2
_ESCAPED = re.compile("%[2-7][0-9a-f]")


def automaton(strict=STRICT, soft=SOFT, in_host=()) -> ahocorasick.Automaton:
    """The automaton of both lists; a term in both is strict."""
    found = ahocorasick.Automaton()
    for term in soft:
        found.add_word(term, (term, False, term in in_host))
    for term in strict:
        found.add_word(term, (term, True, term in in_host))
    found.make_automaton()
    return found


def readable(url: str) -> str:
    """Lower-cased, with percent escapes of ASCII characters undone, once."""
    return _ESCAPED.sub(lambda m: chr(int(m[0][1:], 16)).lower(), url.lower())


def _finds(text: str, terms_of: ahocorasick.Automaton) -> Iterator[tuple[str, bool, bool, int]]:
    """Every term in a text, whether it is strict, whether it counts in hosts, and how many of its sides are free."""
    for end, (term, is_strict, in_host) in terms_of.iter(text):
        start = end - len(term) + 1
        free = (start == 0 or not text[start - 1].isalnum()) + (not text[end + 1:end + 2].isalnum())
        yield term, is_strict, in_host, free


def term_counts(url: str, terms_of: ahocorasick.Automaton, host: str = "") -> tuple[int, int, int, int]:
    """Of one url: strict finds, distinct strict terms, soft finds, distinct soft terms.

    ``host`` is the url's host again, for the terms that need one free side there.
    """
    if not len(terms_of):
        return 0, 0, 0, 0
    hits, terms = [0, 0], (set(), set())
    counted = [(t, s) for t, s, _, free in _finds(readable(url), terms_of) if free == 2]
    counted += [(t, s) for t, s, in_host, free in _finds(readable(host), terms_of) if in_host and free == 1]
    for term, is_strict in counted:
        hits[is_strict] += 1
        terms[is_strict].add(term)
    return hits[1], len(terms[1]), hits[0], len(terms[0])


def vocabulary_hits(url: Column, strict=STRICT, soft=SOFT, in_host=IN_HOST) -> Column:
    """Struct of strict, strict_terms, soft, soft_terms of a url column; null has none."""
    strict, soft, in_host = tuple(strict), tuple(soft), tuple(in_host)

    @F.pandas_udf("strict int, strict_terms int, soft int, soft_terms int")
    def hits(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        terms_of = automaton(strict, soft, in_host)  # once a task
        for urls, hosts in batches:
            yield pd.DataFrame([term_counts(u, terms_of, h) for u, h in zip(urls, hosts)],
                               columns=["strict", "strict_terms", "soft", "soft_terms"], dtype="int32")
    return hits(F.coalesce(url.cast("string"), F.lit("")), url_host(url))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits as struct(rule, verdict), or null.

    A rule is (verdict, host, path prefix); it fits its host and all
    subdomains of it.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        chosen = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"),
                                       F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
               url_col: str = "url", strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT,
               in_host=IN_HOST) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict and the vocabulary counts.

    A null url or one without ``://`` has empty host and path, fits no rule
    with a host, and is judged by the vocabulary on what there is (null:
    allow).  Repeated rows are judged alike; other columns are not read.  Of
    rules of equal length the last in the list wins.  Very long urls are read
    whole, in linear time.  An empty table gives an empty result.
    """
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias(id_col), url_host(url).alias("host"),
                        url_path(url).alias("path"), vocabulary_hits(url, strict, soft, in_host).alias("hits"))
    rows = rows.withColumn("by", fitting_rule(F.col("host"), F.col("path"), rules))
    bad = (F.col("hits.strict_terms") > 0) | (F.col("hits.soft_terms") >= soft_limit)
    return rows.select(
        id_col, "host", "path", F.col("by.rule").alias("rule"),
        F.coalesce(F.col("by.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
        "hits.strict", "hits.strict_terms", "hits.soft", "hits.soft_terms")
