"""URL filter: host and path rules, and a weighted vocabulary for the rest.

Rules come first: a rule ``host/path`` fits its host and all subdomains when the path of the url starts with the rule's;
the longest fitting rule decides. Where none fits, an Aho-Corasick automaton finds the terms of the vocabulary in the url
with A-Z in lower case. A hit counts only between boundaries: the characters next to it are no ASCII letters.
One strict term blocks the url. Distinct soft terms block it together: each weighs 2, or 1 if it is weak, that is, a word of many ordinary
addresses too; from ``soft_limit`` on it is blocked. No soft term does it alone. Forms of one word are one term.

Rows are independent: one pass over the url column in Arrow batches, no shuffle, whatever the size of the input.

Defined results: a NULL url, or one without ``://``, has an empty host and path; a NULL url has no hits, so it is allowed;
repeated rows are judged alike; an empty table gives an empty result. Other columns are carried along unless they are
called like an output.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.llm.text import bundled

# --- Fixed values: rules of the contract -----------------------------------------------------------

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# --- Vocabulary --------------------------------------------------------------------------------------

# A term is a word, or its forms as (one|other): any of them is a hit, together they count as one term. Strict are words and
# phrases that hardly stand in the address of an ordinary page; what has an ordinary sense too (adult education, track and
# field) is soft.


def joined(left: str, right: str) -> str:
    """Phrases of a word of ``left`` and one of ``right``, with a hyphen, an underscore or nothing between, as one term."""
    return "(" + "|".join(a + gap + b for a in left.split() for b in right.split() for gap in ("-", "_", "")) + ")"


STRICT = (
    # adult
    "(porn|porns|porno|pornos|pornstar|pornstars)", "(pornhub|xvideos|xhamster|xnxx|redtube|youporn|brazzers|chaturbate)", "(xxx|xxxx)",
    "(hentai|hentais)", "(camgirl|camgirls|camboy|camboys|camwhore|camwhores)", "escorts", "(milf|milfs)",
    "(blowjob|blowjobs|handjob|handjobs|gangbang|gangbangs|cumshot|cumshots|creampie|creampies)",
    joined("adult adults", "x xx sex video videos film films movie movies cam cams webcam webcams chat chats site sites dating tube toy "
           "toys star stars store stores shop shops pic pics photo photos pictures stories game games personals entertainment hookup "
           "hookups friendfinder"),
    joined("sex sexy", "x cam cams chat chats tube video videos movie movies pic pics shop shops toy toys site sites girl girls date dates"),
    joined("x", "rated adult"),
    # gambling
    "(casino|casinos)", "(sportsbook|sportsbooks)", joined("free online", "slots poker bet bets betting roulette blackjack gambling bingo"),
    # pharmacy
    "(viagra|viagras)", "cialis", "(levitra|kamagra)", joined("online", "pharmacy pharmacies drugstore drugstores pills meds"),
    # spam and software traps
    "(warez|nulled)", "(torrents)", "(phisher|phishers)", "(malwares)", "(keygen|keygens)", "(spams|spammed|spamming|spammy|spammer|spammers)",
)
SOFT = (
    # adult
    "(sex|sexy)", "(nude|nudes|nudity|nudist|nudists)", "(naked)", "(erotic|erotica|erotics|erotik)",
    "(fetish|fetishes)", "(webcam|webcams|cam|cams)", "(escort|escorting)", "(stripper|strippers|striptease)", "(swinger|swingers)",
    "(hookup|hookups|dating)", "(hooker|hookers|whore|whores|slut|sluts)", "(bdsm|nsfw|onlyfans)", "(boob|boobs|tits)", "(anal)", "(lesbians|shemale|shemales)",
    "(pornographic|pornography)",
    # gambling
    "(bet|bets|betting|bettor|bettors)", "(gamble|gambles|gambled|gambling|gambler|gamblers)", "(jackpot|jackpots)",
    "(lottery|lotteries|lotto|lottos)", "(poker|pokers)", "(roulette|roulettes)", "(blackjack|baccarat)", "(bingo|bingos)",
    "(bookmaker|bookmakers|bookie|bookies)", "(wager|wagers|wagered|wagering)", "(spins|freespins)", "(sweepstake|sweepstakes)",
    # pharmacy
    "(pill|pills)", "(drugstore|drugstores)", "(meds)", "(sildenafil|tadalafil|phentermine|tramadol|xanax|ambien|oxycontin|valium)", "(weightloss|slimming)",
    # spam
    "(free|freebie|freebies)", "(payday)", "(replica|replicas)", "(giveaway|giveaways)", "(spam)", "(backlink|backlinks)",
    # adverts
    "(ad|ads|adv|advert|adverts|advertise|advertiser|advertisers|advertising|advertisement|advertisements)",
    "(adserver|adservers|adserving|adclick|adclicks|doubleclick)", "(banner|banners)", "(clickbait)", "(coupon|coupons|voucher|vouchers)",
    "(popup|popups|popunder|popunders)", "(promocode|promocodes)",
)
WEAK = (
    # adult
    "(adult|adults)",
    # gambling
    "(bonus|bonuses)", "(slot|slots)", "(win|wins|winning|winnings)", "(winner|winners)", "(odds)", "(prize|prizes)",
    # pharmacy
    "(pharmacy|pharmacies)", "(drugs)", "(steroid|steroids)",
    # spam and software traps
    "(cheap|cheaper|cheapest)", "(crack|cracks|cracked)", "(deal|deals)", "(discount|discounts|discounted)", "(farm|farms)", "(loan|loans)",
    "(offer|offers)", "(buy)", "(scam|scams|scammer|scammers)", "(torrent)", "(phishing)", "(malware)",
    # adverts
    "(click|clicks)", "(promo|promos|promotion|promotions|promotional)", "(sponsor|sponsors|sponsored|sponsoring)", "(track|tracks|tracked|tracking)",
    "(tracker|trackers)", "(affiliate|affiliates)",
)
SOFT_LIMIT = 3


@cache
def automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for weight, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            for form in term.strip("()").split("|"):
                found.add_word(form, (weight, term, len(form)))
    found.make_automaton()
    return found


def is_solid(char: str) -> bool:
    return char.isascii() and char.isalpha()


def hits(url: str, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms between boundaries; ``url`` has A-Z in lower case."""
    seen: dict[str, set[str]] = {"strict": set(), "soft": set()}
    for end, (weight, term, length) in automaton(strict, soft).iter(url):
        start = end - length + 1
        if (start == 0 or not is_solid(url[start - 1])) and (end + 1 == len(url) or not is_solid(url[end + 1])):
            seen[weight].add(term)
    return seen["strict"], seen["soft"]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(rule: str, host: Column, path: Column) -> Column:
    name, start = rule.split("/", 1)
    return ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)


def judge(
    pages: DataFrame,
    url: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
    strict: tuple[str, ...] = STRICT,
    soft: tuple[str, ...] = SOFT,
    weak: tuple[str, ...] = WEAK,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """Add host, path, rule (NULL where none fits), n_strict, n_soft (distinct terms), soft_weight and verdict (allow or block)."""
    names = ("host", "path", "rule", "n_strict", "n_soft", "soft_weight", "verdict")
    light = frozenset(weak)

    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            found = [hits(u, strict, soft + weak) if u else (set(), set()) for u in urls]
            counted = {
                "n_strict": [len(a) for a, _ in found],
                "n_soft": [len(b) for _, b in found],
                "soft_weight": [2 * len(b) - len(b & light) for _, b in found],
            }
            yield pd.DataFrame(counted, dtype="int64")

    counted = F.pandas_udf(counts, "n_strict bigint, n_soft bigint, soft_weight bigint")
    whole = F.translate(F.col(url), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    others = [n for n in pages.columns if n not in names or n == url]
    rows = pages.select(bundled(others).alias("_row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), whole.alias("_whole"))
    host, path = F.col("host"), F.col("path")
    longest = sorted(rules, key=lambda r: -len(r[1]))
    rule = F.coalesce(*[F.when(fits(text, host, path), F.lit(text)) for _, text in longest])
    ruled = F.coalesce(*[F.when(fits(text, host, path), F.lit(verdict)) for verdict, text in longest])
    rows = rows.withColumns({"rule": rule, "_ruled": ruled, "_hits": counted(F.col("_whole"))})
    blocked = (F.col("_hits.n_strict") >= 1) | (F.col("_hits.soft_weight") >= soft_limit)
    verdict = F.coalesce("_ruled", F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    kept = [F.col("_row").getField(n).alias(n) for n in others]
    return rows.select(*kept, "host", "path", "rule", "_hits.*", verdict.alias("verdict"))
