"""URL filtering by pattern rules that are found through their rarest literal token.

A pattern is a regular expression searched in the whole lower-cased url. Its literal tokens are the alphanumeric runs that
every match must contain between non-alphanumeric characters; each rule is filed under the one that the fewest rules
have. The tokens of a url then fetch the few rules that can match, and only these run their expressions. Rules without
a literal token are tried on every url. Host rules are patterns as well: ``host/path`` fits the host, its subdomains and
the paths that start with it, and the longest that fits decides; pattern rules decide where no host rule fits.

Null urls and urls without ``://`` have an empty host and path and no rule; pattern rules still see them. Repeated rows
give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.llm.shared import col, per_text

BLOCK, ALLOW = "block", "allow"
TOKEN = re.compile(r"[a-z0-9]+")
TO_HOST = r"(?s)\A(?>.*?://)"


@dataclass(frozen=True)
class Rule:
    """``tokens``: every matching url has all of them as whole alphanumeric runs."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    is_host: bool = False


def host_rule(name: str, verdict: str) -> Rule:
    """``example.net/en/`` fits example.net and its subdomains, for paths that begin with /en/."""
    host, slash, path = name.partition("/")
    path = slash + path
    complete = host + path[: path.rfind("/") + 1]  # a last path token may go on in the url
    pattern = rf"{TO_HOST}(?:[^/?#]*\.)?{re.escape(host)}(?=[/?#]|\Z){re.escape(path)}"
    return Rule(name, verdict, pattern, tuple(TOKEN.findall(complete.lower())), True)


def word_rule(words: str, verdict: str = BLOCK) -> Rule:
    """Fits urls whose host has the words, put together by hyphens, as one whole part of a name."""
    pattern = rf"{TO_HOST}(?:[^/?#]*[.\-])?{re.escape(words)}(?:[.\-][^/?#]*)?(?:[/?#]|\Z)"
    return Rule(words, verdict, pattern, tuple(TOKEN.findall(words)))


def label_rule(word: str) -> Rule:
    """Fits urls whose host has the word as a whole part between dots or hyphens."""
    pattern = rf"{TO_HOST}(?:[^/?#]*[.\-])?{re.escape(word)}(?:[.\-][^/?#]*)?(?:[/?#]|\Z)"
    return Rule(f"host {word}", BLOCK, pattern, (word,))


def path_rule(words: str) -> Rule:
    """Fits urls whose path has the words as one whole folder."""
    pattern = rf"{TO_HOST}[^/?#]*/(?:[^?#]*/)?(?i:{re.escape(words)})/"
    return Rule(f"path {words}", BLOCK, pattern, tuple(TOKEN.findall(words)))


#: Words by category that stand alone in host names of such sites, and folders that advertising is served from, in the
#: manner of public filter lists. A list can't be complete; words with a common innocent use are left out.
HOST_WORDS = {
    "advertising": "ads adserver adservers adservice adclick adtrack adtracker adnetwork adsystem banners doubleclick popunder clickbank",
    "gambling": "casino casinos poker roulette blackjack slots jackpot sportsbook bookmaker bookmakers betting gambling freebets",
    "adult": "xxx porn porno adult nsfw escorts hentai camgirls webcamsex",
    "spam": "viagra cialis levitra payday linkfarm spamfarm replicawatches pillstore cheappills",
}
PATH_WORDS = {
    "advertising": "ads adserver adserve adclick adframe adbanner ad-banner banner-ads popunder popups doubleclick sponsored-links",
    "gambling": "online-casino casino-bonus free-bets free-spins online-poker sports-betting",
    "adult": "porn porno xxx hentai nsfw adult-videos",
    "spam": "buy-viagra buy-cialis cheap-pills payday-loans replica-watches",
}

# The host rules of the contract, and the pattern rules: pairs of words that the query's SQL names, then the
# general ones.
HOST_RULES = (
    host_rule("net/", BLOCK),
    host_rule("example.net/en/", ALLOW),
    host_rule("example.com/de/", BLOCK),
    host_rule("org/fr/", ALLOW),
)
PATTERN_RULES = tuple(
    word_rule(words) for words in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
) + tuple(
    make(word) for make, lists in ((label_rule, HOST_WORDS), (path_rule, PATH_WORDS)) for words in lists.values() for word in words.split()
)


class RuleIndex:
    """Rules by their rarest literal token."""

    def __init__(self, rules: tuple[Rule, ...]):
        seen = Counter(token for rule in rules for token in set(rule.tokens))
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        self.rules = [(rule, re.compile(rule.pattern, re.ASCII)) for rule in rules]
        for i, rule in enumerate(rules):
            rarest = min(rule.tokens, key=lambda t: (seen[t], -len(t), t), default=None)
            (self.always if rarest is None else self.by_token.setdefault(rarest, [])).append(i)

    def candidates(self, url: str) -> list[int]:
        found = set(self.always)
        for token in set(TOKEN.findall(url)):
            found.update(self.by_token.get(token, ()))
        return sorted(found)

    def judge(self, url: str) -> tuple[str | None, str, list[str]]:
        """(deciding host rule, verdict, every rule that fits) of an url whose host is in lower case."""
        fits = [self.rules[i][0] for i in self.candidates(lower(url)) if self.rules[i][1].search(url)]
        hosts = [r for r in fits if r.is_host]
        patterns = [r for r in fits if not r.is_host]
        names = [r.name for r in fits]
        if hosts:
            longest = max(hosts, key=lambda r: len(r.name))
            return longest.name, longest.verdict, names
        return None, BLOCK if any(r.verdict == BLOCK for r in patterns) else ALLOW, names


def lower(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    return text.encode().lower().decode()


def parts(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path), both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judged(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = HOST_RULES + PATTERN_RULES) -> Column:
    """A struct (rule, verdict, fits) for each url of ``pages``."""

    def start():
        index = RuleIndex(rules)

        def one(value: str) -> tuple:
            scheme, mark, rest = value.partition("://")
            end = re.search(r"[/?#]|\Z", rest).start()
            return index.judge(scheme + mark + lower(rest[:end]) + rest[end:])

        return one

    return per_text(start, "rule string, verdict string, fits array<string>")(col(url))
