"""URL filter: pattern rules indexed by their rarest literal token.

Every rule, domain rule or pattern, becomes one regular expression over ``host + path`` (domain
rules) or over the whole URL (patterns). A rule's *literal tokens* are the runs of ``[a-z0-9]``
that must appear in any URL it fits as complete tokens, that is, bounded on both sides by
characters that are not alphanumeric. The rule is filed under the one of its tokens that the
fewest URLs of the table hold (counted over all rows). A URL's own tokens fetch the candidate
rules, and only those run their regular expression. Rules without a complete token sit in a
short list that every URL tries.

Pattern syntax (the common ad-filter one): ``*`` is any run of characters, ``^`` a separator (anything
but letters, digits, ``_``, ``%`` and ``-``) or an end of the url, a leading ``||`` the start of the host or
of one of its parent domains, a leading or trailing ``|`` the start or end of the url, a leading ``@@`` an
exception, a trailing ``$match-case`` keeps letter case; any other option is an error. All else is
literal, and matching is case-insensitive and unanchored.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no
domain rule; patterns still look at the url text; a null url fits nothing. Among domain rules
that fit the longest rule text wins, then the longer host, then ``block``. A URL that fits no
domain rule is blocked if a pattern fits and no exception does, else allowed. Repeated rows are judged alike, extra
columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import batch

#: The domain rules of the contract (action, host, path).
DOMAIN_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Default patterns for URLs that no domain rule decides: advertising, trackers, spam topics.
PATTERNS = (
    "^adserver^", "^doubleclick^", "^banner^ads^", "^casino^", "^poker^", "^viagra^", "^porn^",
    "^xxx^", "^torrent^", "^warez^", "^phishing^", "^malware^", "^click^track^", "^affiliate^id=",
    "^popup^ads^", "^login^.php^redirect=", "^cgi-bin^tracker", "^escort^", "^lottery^winner^",
    "||ads.", "||adserver", "||adult-", "||casino-", "||spam-", "||cheap-*-pills.", "||cheap-pills.", "-casino.", "-pills.",
    "@@||adult-education.", "@@||spam-filter.", "@@/ads.txt",
)

TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """One rule: ``kind`` is ``domain`` or ``pattern``; ``tokens`` its complete literal tokens."""

    action: str
    kind: str
    text: str
    host: str
    regex: str
    tokens: tuple[str, ...]
    match_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.regex, re.A if self.kind == "pattern" and self.match_case else re.I | re.A if self.kind == "pattern" else 0)


def ascii_lower(text: str) -> str:
    return text.encode().lower().decode()


def domain_rule(action: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    # a token that touches the end of the path may go on in the url ("/foo" fits "/foobar")
    closed = re.sub(r"[A-Za-z0-9]+$", "", path)
    return Rule(action, "domain", host + path, host, rf"^(?:[^/]*\.)?{re.escape(host)}(?=/|$){re.escape(path)}",
                tuple(TOKEN.findall(ascii_lower(host)) + TOKEN.findall(ascii_lower(closed))))


def pattern_rule(text: str) -> Rule:
    """One pattern. A literal run next to ``*`` or at an open end of the pattern may go on in the url, so
    it is no complete token."""
    body, option, value = text.partition("$")
    if option and value != "match-case":
        raise ValueError(f"unknown option in pattern {text!r}")
    exception = body.startswith("@@")
    body = body[2:] if exception else body
    domain, start = body.startswith("||"), body.startswith("|")
    body = body.lstrip("|") if start else body
    end = body.endswith("|")
    body = body[:-1] if end else body
    parts = {"*": ".*", "^": r"(?:[^A-Za-z0-9_%-]|^|$)"}
    regex = "".join(parts.get(c) or re.escape(c) for c in (body if value else ascii_lower(body)))
    regex = (r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*\.)?" if domain else "^" if start else "") + regex + (r"\Z" if end else "")
    body = ascii_lower(body)
    tokens = tuple(m.group() for m in TOKEN.finditer(body)
                   if (body[m.start() - 1] != "*" if m.start() else start) and (body[m.end()] != "*" if m.end() < len(body) else end))
    return Rule("allow" if exception else "block", "pattern", text, "", regex, tokens, match_case=bool(value))


def default_rules() -> list[Rule]:
    return [domain_rule(*r) for r in DOMAIN_RULES] + [pattern_rule(p) for p in PATTERNS]


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host between the first ``://`` and ``/ ? #``, A-Z lower-cased; path up to ``? #``."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    return ascii_lower(rest[:end]), re.split(r"[?#]", rest[end:], maxsplit=1)[0]


def url_tokens(url: str) -> set[str]:
    return set(TOKEN.findall(ascii_lower(url)))


def token_counts(urls: DataFrame, url: str, wanted: Sequence[str]) -> dict[str, int]:
    """In how many URLs each wanted token stands; over all rows, one small sum per token."""
    tokens = F.array_distinct(F.split(F.lower(F.col(url)), "[^a-z0-9]+"))
    rows = (urls.select(F.explode(F.array_intersect(tokens, F.array(*map(F.lit, wanted)))).alias("token"))
            .groupBy("token").count().collect())  # bounded by the number of rule tokens
    return {r["token"]: r["count"] for r in rows}


class RuleIndex:
    """Rules by their rarest token; ``judge`` runs only the candidates a URL's tokens fetch."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]):
        self.always: list[tuple[Rule, re.Pattern]] = []
        self.by_token: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        for rule in rules:
            entry = (rule, rule.compiled())
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
                self.by_token.setdefault(rarest, []).append(entry)
            else:
                self.always.append(entry)

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, int]:
        """(host, path, rule, verdict, candidates tried)."""
        host, path = split_url(url)
        if url is None:
            return host, path, None, "allow", 0
        candidates = list(self.always)
        for token in url_tokens(url):
            candidates += self.by_token.get(token, ())
        target = host + path
        best = None
        for rule, regex in candidates:
            if rule.kind == "domain" and regex.search(target):
                key = (len(rule.text), len(rule.host), rule.action == "block")
                if best is None or key > best[0]:
                    best = (key, rule)
        if best:
            return host, path, best[1].text, best[1].action, len(candidates)

        def fits(action: str) -> bool:
            return any(rule.kind == "pattern" and rule.action == action and regex.search(url) for rule, regex in candidates)

        blocked = fits("block") and not fits("allow")
        return host, path, None, "block" if blocked else "allow", len(candidates)


def filter_urls(pages: DataFrame, rules: Sequence[Rule] | None = None, page_id: str = "page_id",
                url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, n_candidates for every row of ``pages``."""
    rules = default_rules() if rules is None else list(rules)
    wanted = sorted({t for r in rules for t in r.tokens})
    index_counts = token_counts(pages, url, wanted) if wanted else {}
    kind = pages.schema[page_id].dataType
    schema = f"`{page_id}` {kind.simpleString()}, host string, path string, rule string, verdict string, n_candidates int"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(rules, index_counts)
        for b in batches:
            found = [index.judge(u) for u in b.column(1).to_pylist()]
            host, path, rule, verdict, tried = zip(*found) if found else ([],) * 5
            out = pa.schema([pa.field(page_id, b.column(0).type), ("host", pa.string()), ("path", pa.string()),
                             ("rule", pa.string()), ("verdict", pa.string()), ("n_candidates", pa.int32())])
            yield batch(out, **{page_id: b.column(0), "host": host, "path": path, "rule": rule,
                                "verdict": verdict, "n_candidates": tried})

    return pages.select(page_id, url).mapInArrow(judge, schema)
