"""URL filters: pattern rules indexed by their rarest literal token (operator 1, native)."""

from __future__ import annotations

import json
import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

MAX_RULES = 50_000
ALLOW, BLOCK = "allow", "block"
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``text`` names a host and a path, as ``example.com/en/``; ``*`` stands for any characters.

    The host fits itself and its subdomains; the path fits every path that starts with it. A rule
    without a host (``*/ads/``) fits any host.
    """

    action: str
    text: str

    def regex(self) -> str:
        """Pattern on lower-cased host + path (a path is empty or starts with ``/``)."""
        host, slash, path = self.text.partition("/")
        wild = lambda s, any_: any_.join(re.escape(x) for x in s.split("*"))
        hosts = "" if host == "*" else "(?:[^/]*[.])?" + wild(_lower(host), "[^/]*")
        return "\\A" + (hosts if host != "*" else "[^/]*") + (slash + wild(path, ".*") if slash else "(?:/|\\z)")

    def tokens(self) -> list[str]:
        """Literal tokens that any fitting URL has: whole ones, so not beside ``*`` or at an open end."""
        text = _lower(self.text) if "/" in self.text else _lower(self.text) + "/"
        return [m[0] for m in re.finditer(TOKEN, text)
                if text[m.end():m.end() + 1] not in ("", "*") and text[max(0, m.start() - 1):m.start()] != "*"]


#: The contract's rules, and those that decide where none of them fits.
RULES = tuple(Rule(a, t) for a, t in (
    (ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/")))
PATTERNS = tuple(Rule(BLOCK, t) for t in ("spam-farm.*/", "*/ads/", "*/wp-login.php", "*/cgi-bin/"))


def _lower(s: str) -> str:
    return s.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def _lower_col(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/ ? #``, A-Z lower-cased) and path (up to ``? #``)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.regexp_extract(F.coalesce(rest, F.lit("")), "(?s)\\A[^?#]*", 0)
    host = F.substring_index(rest, "/", 1)
    return _lower_col(host), F.substring(rest, F.length(host) + 1, F.length(rest))


def tokens_of(host: Column, path: Column) -> Column:
    return F.regexp_extract_all(_lower_col(F.concat(host, path)), F.lit(f"({TOKEN})"), 1)


def token_counts(urls: DataFrame, rules: list[Rule], url_col: str = "url") -> dict[str, int]:
    """In how many tokens of all URLs each rule token occurs: as many rows as rules have tokens."""
    wanted = sorted({t for r in rules for t in r.tokens()})
    found = urls.select(F.explode(F.filter(tokens_of(*host_and_path(F.col(url_col))), lambda t: t.isin(wanted))).alias("t"))
    return {t: 0 for t in wanted} | {r["t"]: r["n"] for r in found.groupBy("t").agg(F.count("*").alias("n")).collect()} if wanted else {}


def _index(rules: list[Rule], counts: dict[str, int]) -> tuple[Column, int]:
    """Hash table as one constant: bucket number -> rules, each under its rarest token.

    The last bucket holds rules without a token, which every URL tries.
    """
    n = max(16, 2 * len(rules))
    rows = [{"tok": min(r.tokens(), key=lambda t: (counts.get(t, 0), -len(t), t), default=""), "regex": r.regex(),
             "text": r.text, "act": r.action, "rank": i} for i, r in enumerate(rules)]
    table: list[list[dict]] = [[] for _ in range(n + 1)]
    for row in rows:
        table[_bucket(row["tok"], n) if row["tok"] else n].append(row)
    schema = "array<array<struct<tok:string,regex:string,text:string,act:string,rank:int>>>"
    return F.from_json(F.lit(json.dumps(table)), schema), n


def _bucket(token: str, n: int) -> int:
    """crc32 is the same in Spark and in Python."""
    import zlib

    return zlib.crc32(token.encode()) % n


def _best(host: Column, path: Column, rules: list[Rule], counts: dict[str, int]) -> Column:
    """The longest fitting rule (of equally long ones the first) as a struct, or null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules fit the index; got {len(rules)}")
    if not rules:
        return F.lit(None).cast("struct<len:int,first:int,text:string,act:string>")
    table, n = _index(rules, counts)
    toks = F.array_distinct(tokens_of(host, path))
    fetched = F.flatten(F.transform(toks, lambda t: F.filter(
        F.element_at(table, (F.pmod(F.crc32(t), F.lit(n)) + 1).cast("int")), lambda r: r["tok"] == t)))
    tried = F.concat(fetched, F.element_at(table, F.lit(n + 1)))
    whole = F.concat(host, path)
    fits = F.filter(tried, lambda r: F.regexp_like(whole, r["regex"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(
        F.length(r["text"]).alias("len"), (-r["rank"]).alias("first"), r["text"].alias("text"), r["act"].alias("act"))))


def url_filter(pages: DataFrame, rules: tuple[Rule, ...] = RULES, patterns: tuple[Rule, ...] = PATTERNS,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict`` per row.

    Each rule is indexed by the one of its literal tokens that the URLs have least often. A URL's
    tokens fetch candidate rules from the index, and only those run regular expressions. The longest
    fitting one of ``rules`` decides and is returned as ``rule``; where none fits, ``rule`` is null
    and the longest fitting one of ``patterns`` decides, and else the verdict is allow.

    Null URLs and URLs without ``://`` have empty host and path, so they are allowed by default.
    Repeated rows and null ids are judged like any other; columns other than the two named are not
    read, so their names cannot clash; an empty table gives an empty result. The index is a constant
    of the plan of at most ``MAX_RULES`` rules, so there is no shuffle and nothing grows with the pages.
    """
    both = [*rules, *patterns]
    counts = token_counts(pages, both, url_col)
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    judged = split.select(F.col(id_col), "host", "path", _best(F.col("host"), F.col("path"), list(rules), counts).alias("hit"),
                          _best(F.col("host"), F.col("path"), list(patterns), counts).alias("other"))
    return judged.select(id_col, "host", "path", F.col("hit.text").alias("rule"),
                         F.coalesce("hit.act", "other.act", F.lit(ALLOW)).alias("verdict"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(documents(spark, sf_dir, "pages"))


OP1_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*', 0) ELSE '' END AS rest
           FROM pages),
p AS (SELECT page_id, translate(split_part(coalesce(rest, ''), '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             substr(coalesce(rest, ''), length(split_part(coalesce(rest, ''), '/', 1)) + 1) AS path FROM u),
r(action, rule, h, pre) AS (VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
j AS (SELECT p.page_id, p.host, p.path,
        (SELECT arg_max(rule, length(rule)) FROM r WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, pre)) AS rule
      FROM p)
SELECT page_id, host, path, rule,
  coalesce((SELECT action FROM r WHERE r.rule = j.rule),
    CASE WHEN regexp_matches(host || path, '^([^/]*[.])?spam-farm[.][^/]*/') OR starts_with(path, '/ads/')
              OR starts_with(path, '/wp-login.php') OR starts_with(path, '/cgi-bin/') THEN 'block' ELSE 'allow' END) AS verdict
FROM j
"""
