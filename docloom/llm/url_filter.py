"""URL filters: host and path rules first, then a weighted vocabulary that an Aho-Corasick automaton counts.

The automaton holds all terms and is built once in each task from a list of fixed size. A hit counts only between boundaries
(characters other than letters and digits, or an end of the url). One strict term, or distinct soft terms whose weights add up to
`soft_limit`, reject a url. Of the host and path rules that fit, the longest decides, before the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The rules of the production list: (host, path prefix, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]

# Terms that alone reject a url. Lower case, letters and digits only, as all terms.
STRICT = [
    "porn", "porno", "pornography", "pornos", "pornstar", "pornstars", "xxx", "hentai", "hardcore", "camgirl", "camgirls", "camsex", "livesex", "sexcam", "sexcams", "sexchat", "sextube", "porntube", "xvideos", "milf",
    "milfs", "blowjob", "blowjobs", "cumshot", "cumshots", "creampie", "gangbang", "bukkake", "upskirt", "voyeurism", "escorts", "callgirls", "hookups", "fetish", "bdsm", "nsfw", "warez", "keygens", "nulled", "cracked",
    "phishing", "malware", "ransomware", "botnet", "spyware", "trojan", "carding", "fullz", "linkfarm", "spamfarm", "darkmarket",
]

# Terms that reject a url together with others, by weight: 2 for those that seldom mean anything else, 1 for those that often do.
SOFT = {
    # adult
    "adult": 2, "adults": 1, "sex": 2, "sexy": 2, "sexual": 1, "nude": 2, "nudes": 2, "naked": 1, "erotic": 2, "erotica": 2, "lingerie": 1, "webcam": 1, "webcams": 1, "dating": 1, "singles": 1, "hot": 1, "babes": 2,
    "teen": 1, "teens": 1, "girls": 1, "lesbian": 1, "gay": 1, "swingers": 2, "escort": 2, "massage": 1, "stripper": 2, "strippers": 2, "playboy": 2, "pinup": 1, "amateur": 1, "uncensored": 2,
    # gambling
    "casino": 2, "casinos": 2, "poker": 2, "betting": 2, "bet": 1, "bets": 1, "bookmaker": 2, "bookmakers": 2, "slots": 2, "slot": 1, "jackpot": 2, "jackpots": 2, "roulette": 2, "blackjack": 2, "baccarat": 2, "lottery": 1,
    "lotto": 1, "gambling": 2, "wager": 2, "freespins": 2, "bonus": 1, "odds": 1,
    # medicines and drugs
    "viagra": 2, "cialis": 2, "levitra": 2, "xanax": 2, "valium": 2, "tramadol": 2, "oxycontin": 2, "phentermine": 2, "steroids": 2, "pharma": 1, "pharmacy": 1, "pills": 2, "pill": 1, "prescription": 1, "cheap": 1, "discount": 1,
    "weightloss": 2, "slimming": 1, "enlargement": 2, "cannabis": 1, "weed": 1, "cbd": 1,
    # copies without licence
    "torrent": 2, "torrents": 2, "crack": 1, "cracks": 2, "keygen": 2, "serial": 1, "serials": 1, "cheats": 1, "hack": 1, "hacks": 1, "pirate": 1, "pirated": 2, "rapidshare": 2, "megaupload": 2, "leaked": 1, "leaks": 1, "apk": 1,
    # money and goods
    "loan": 1, "loans": 1, "payday": 2, "forex": 1, "crypto": 1, "bitcoin": 1, "airdrop": 2, "giveaway": 1, "getrich": 2, "millionaire": 1, "replica": 2, "replicas": 2, "knockoff": 2, "counterfeit": 2, "rolex": 1, "vuitton": 1, "outlet": 1,
    # spam
    "spam": 2, "clickbait": 2, "backlink": 1, "backlinks": 2, "seo": 1, "autoblog": 2, "doorway": 1, "sponsored": 1, "promo": 1, "coupon": 1, "coupons": 1, "popunder": 2, "adfly": 2, "surveys": 1,
}


def _hits(automaton, url: str) -> tuple[int, int, int]:
    """Of the url's distinct terms that stand between boundaries: how many are strict, how many soft, and the weight of the soft ones."""
    text = url.translate(_LOWER)
    found: dict[str, int] = {}
    for end, (weight, term) in automaton.iter(text):
        start = end - len(term) + 1
        if not (start and text[start - 1] in _INSIDE) and not (end + 1 < len(text) and text[end + 1] in _INSIDE):
            found[term] = weight
    soft = [w for w in found.values() if w]
    return len(found) - len(soft), len(soft), sum(soft)


_LOWER = {c: c + 32 for c in range(65, 91)}
_INSIDE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
HITS = ["strict_hits", "soft_hits", "soft_weight"]


def filter_urls(pages: DataFrame, rules=tuple(RULES), strict=tuple(STRICT), soft=tuple(SOFT.items()), soft_limit: int = 3) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, strict_hits, soft_hits, soft_weight.

    The host lies between the first `://` and the next `/`, `?`, `#` or the end, with A-Z in lower case; the path goes on to `?`,
    `#` or the end. A null url, or one without `://`, has an empty host and path, and only the vocabulary judges it (a null url
    has no hits and is allowed). Terms count once however often they stand in the url; a term in both lists is strict. Ties
    between rules of equal length go to the later one in `rules`. Urls are searched whole, however long; repeated rows are judged
    alike. An empty table gives an empty result. Soft terms weigh less than `soft_limit`, so one alone never rejects.
    """
    ordered = sorted(((h, p, v) for h, p, v in rules), key=lambda r: len(r[0] + r[1]))
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.expr("substring(url, instr(url, '://') + 3)"), "#", 1)).otherwise("")
    located = (
        pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"))
        .withColumn("_rest", F.substring_index(rest, "?", 1))
        .withColumn("host", F.translate(F.substring_index("_rest", "/", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        .withColumn("path", F.expr("substring(_rest, length(substring_index(_rest, '/', 1)) + 1)"))
    )
    rule, by_rule = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in ordered:
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        rule, by_rule = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(by_rule)
    terms = {**dict(soft), **{t: 0 for t in strict}}
    if any(w < 1 or w >= soft_limit for t, w in soft):
        raise ValueError("a soft term's weight must lie between 1 and soft_limit - 1")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, weight in terms.items():
            automaton.add_word(term, (weight, term))
        automaton.make_automaton()
        for batch in batches:
            hits = [_hits(automaton, u) if terms else (0, 0, 0) for u in batch.column("url").to_pylist()]
            kept = ["page_id", "host", "path", "rule", "by_rule"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array([h[i] for h in hits], pa.int32()) for i in range(3))], [*kept, *HITS])

    counted = located.select("page_id", "url", "host", "path", rule.alias("rule"), by_rule.alias("by_rule")).mapInArrow(count, "page_id long, host string, path string, rule string, by_rule string, strict_hits int, soft_hits int, soft_weight int")
    by_terms = F.when((F.col("strict_hits") > 0) | (F.col("soft_weight") >= soft_limit), "block").otherwise("allow")
    return counted.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_terms).alias("verdict"), *HITS)
