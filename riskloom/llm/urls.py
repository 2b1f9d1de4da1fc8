"""URL rules answered by a cascade of Bloom filters.

A rule is (verdict, host, path). It fits a url whose host is the rule's or a subdomain of it
and whose path starts with the rule's; of several the longest (host plus path, then host)
decides. A url can only be hit by keys that have the shape of some rule, so its candidate
keys are its last ``k`` labels followed by the first ``n`` characters of its path, for the
(k, n) that rules have. All candidate keys of the corpus are the key universe.

Level 1 of the cascade encodes the listed keys, level 2 the keys of the universe that level 1
takes for listed by mistake, level 3 the listed keys that level 2 takes for such, and so on
until a level errs no more. A key then is listed if the first level that lacks it is an even
one, or if it passes all of an odd number of levels: exact for each key of the universe, and
no join is needed to judge. A second cascade tells blocked keys from allowed ones; its universe
are the listed keys. The first level's error rate is chosen so that about as many keys err as
are listed: the filters grow with the list and with the logarithm of the universe.

Filters travel as literals. Lists longer than ``MOST_RULES`` are applied in parts of that
length, one pass each, and the best rule so far is carried along: the size of a plan is bounded.

Everything is DataFrame expressions. A null url and one without ``://`` have an empty host and
path. Hosts are lower-cased in A-Z only; ports, user names and empty labels are part of the
host as written. Rows are neither dropped nor merged, repeated and null ids included. Columns
named host, path, rule, verdict are replaced. An empty rule list gives every url the default.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import quoted, scratch, spare

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rules whose filters go into one plan: some 25 bits each, 60 kB in all.
MOST_RULES = 20_000
MOST_LEVELS = 100

Rule = tuple[str, str, str]


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``hashes`` bits of ``bits`` for a key, in 64-bit words."""

    number: int
    bits: int
    hashes: int
    words: tuple[int, ...] = ()

    def positions(self, key: Column) -> list[Column]:
        h = F.xxhash64(key, F.lit(self.number))
        low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
        return [F.pmod(low + high * i, F.lit(self.bits)).cast("int") for i in range(1, self.hashes + 1)]

    def has(self, key: Column) -> Column:
        words = F.expr("array(" + ",".join(f"{w}L" if w > -(1 << 63) else "(-9223372036854775807L - 1L)" for w in self.words) + ")")
        found = F.lit(True)
        for at in self.positions(key):
            word = F.element_at(words, (at / 64).cast("int") + 1)
            found &= F.getbit(word, F.pmod(at, F.lit(64))) == 1
        return found


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        inside = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            # past an odd level only listed keys and its mistakes go on; an even level is the reverse
            inside = F.when(level.has(key), inside).otherwise(level.number % 2 == 0)
        return inside

    @property
    def bits(self) -> int:
        return sum(level.bits for level in self.levels)


def _encode(keys: DataFrame, number: int, count: int, error: float) -> Level:
    bits = max(64, 64 * math.ceil(count * math.log2(1 / error) / math.log(2) / 64))
    level = Level(number, bits, max(1, round(math.log2(1 / error))))
    at = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("at"))
    set_bits = at.groupBy((F.col("at") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(at, 64) as int))")).alias("w")
    )
    words = [0] * (bits // 64)
    for r in set_bits.collect():  # at most the words of the filter
        words[r["word"]] = r["w"]
    return Level(number, bits, level.hashes, tuple(words))


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade that tells the ``key`` values of ``listed`` from the others of ``universe``.

    ``listed`` holds distinct keys and is short; ``universe`` may repeat keys and list keys of
    ``listed`` too. Only keys that pass the first level are shuffled.
    """
    count = listed.count()
    if not count:
        return Cascade()
    size = universe.agg(F.approx_count_distinct("key")).first()[0]
    first = _encode(listed, 1, count, min(0.5, count / (math.sqrt(2) * max(size, 1))))
    wrong = universe.where(F.col("key").isNotNull()).where(first.has(F.col("key"))).select("key")
    wrong = scratch(wrong.join(F.broadcast(listed), "key", "left_anti").distinct(), "urls")
    cascade, inside, outside = Cascade([first]), listed, wrong
    while count := outside.count():
        if len(cascade.levels) >= MOST_LEVELS:
            raise RuntimeError("keys that no level tells apart")
        level = _encode(outside, len(cascade.levels) + 1, count, 0.5)
        cascade.levels.append(level)
        inside, outside = outside, scratch(inside.where(level.has(F.col("key"))), "urls")
    return cascade


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where it is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Keys of a url that rules of these shapes could name: structs of (length, host length, key)."""
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules})
    keys = []
    for labels, chars in shapes:
        tail = F.substring_index(host, ".", -labels)
        fits = (F.length(host) - F.length(F.replace(host, F.lit("."))) >= labels - 1) & (F.length(path) >= chars)
        key = F.concat(tail, F.substring(path, 1, chars))
        keys.append(F.when(fits, F.struct(F.length(key).alias("chars"), F.length(tail).alias("host_chars"), key.alias("key"))))
    return F.array_compact(F.array(*keys))


def _checked(rules: Sequence[Rule]) -> list[Rule]:
    """Distinct rules; a key that is both blocked and allowed is blocked."""
    known: dict[tuple[str, str], str] = {}
    for verdict, host, path in rules:
        if verdict not in ("block", "allow"):
            raise ValueError("a verdict is block or allow")
        if not host or "/" in host or (path and not path.startswith("/")):
            raise ValueError("a rule needs a host without a slash and a path that is empty or begins with one")
        key = (host.translate(str.maketrans(UPPER, LOWER)), path)
        known[key] = "block" if "block" in (verdict, known.get(key)) else "allow"
    return [(v, h, p) for (h, p), v in sorted(known.items())]


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, the rule that decides (or null) and the verdict."""
    rules = _checked(rules)
    host, path = host_and_path(F.col(quoted(url)).cast("string"))
    made = ["host", "path", "rule", "verdict"]
    kept = [quoted(c) for c in pages.columns if c.lower() not in made]
    best = spare(pages, "best")
    nothing = F.lit(None).cast("struct<chars:int,host_chars:int,key:string,blocked:boolean>")
    rows = pages.select("*", nothing.alias(best))
    for start in range(0, len(rules), MOST_RULES):
        part = rules[start : start + MOST_RULES]
        listed = pages.sparkSession.createDataFrame([(v == "block", h + p) for v, h, p in part], "blocked boolean, key string")
        keys = candidate_keys(host, path, part)
        universe = pages.select(F.explode(keys).alias("k")).select("k.key")
        any_rule = build(listed.select("key"), universe)
        blocked = build(listed.where("blocked").select("key"), listed.select("key"))
        hits = F.filter(keys, lambda k: any_rule.contains(k["key"]))  # noqa: B023
        hit = F.array_max(hits)
        hit = F.when(hit.isNotNull(), F.struct(hit["chars"].alias("chars"), hit["host_chars"].alias("host_chars"), hit["key"].alias("key"), blocked.contains(hit["key"]).alias("blocked")))
        rows = rows.select(*[quoted(c) for c in pages.columns], F.greatest(F.col(quoted(best)), hit).alias(best))
        if start + MOST_RULES < len(rules):
            rows = scratch(rows, "urls")
    chosen = F.col(quoted(best))
    verdict = F.when(chosen.isNull(), default).when(chosen["blocked"], "block").otherwise("allow")
    return rows.select(*kept, host.alias("host"), path.alias("path"), chosen["key"].alias("rule"), verdict.alias("verdict"))
