"""URL filter by a bit-parallel wildcard automaton.

All glob rules are packed into one vector of 64-bit words (Shift-And): a rule has a start bit and a bit for each symbol.
Reading a byte ``c`` turns the state ``D`` into ``((D << 1) & STEP[c]) | (D & STAY[c])``, the shift carrying over word
borders; ``STAY`` holds the bits whose position is followed by a run (``*``) that may take ``c``. After the last byte the
rules whose last bit is set have matched. All URLs of an Arrow batch advance together, one byte position at a time, so a step
is a few NumPy operations; nothing is shuffled.

Host rules (``example.com/en/``) fit a host, its subdomains and the paths that start so: they are the glob
``<run without slash>.example.com/en/*`` over ``.host/path``. The longest that matches decides. Where none does, the globs
over the same text decide: a match blocks, else the URL is allowed.

Nulls and URLs without ``://`` have an empty host and path, match no host rule and are allowed. Ties between rules cannot be,
as rules differ; rows that repeat are judged alike; an empty table gives no rows. Extra columns stay; ``host``, ``path``,
``rule`` and ``verdict`` replace those of the same name.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthpanel.llm.batches import bytes_of
from monthpanel.llm.shared import free_names, table

#: Host rules of the filter, fixed values.
HOST_RULES = (
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Globs that block where no host rule fits, fixed values.
BLOCK_GLOBS = ("*.exe", "*.zip", "*/login*", "*/cart/*", "*.onion/*")


class Automaton:
    """The packed rules. ``?`` is one byte, ``*`` a run of any bytes; host rules are given as such."""

    def __init__(self, host_rules: list[str], globs: list[str]):
        every, no_slash = np.ones(256, bool), np.ones(256, bool)
        no_slash[ord("/")] = False
        one = np.eye(256, dtype=bool)
        rules = [[(None, no_slash), *((one[b], None) for b in f".{rule}".encode()), (None, every)] for rule in host_rules]
        for glob in globs:
            rules.append([(None, every) if b == ord("*") else (every, None) if b == ord("?") else (one[b], None) for b in glob.encode()])
        bits = sum(1 + sum(step is not None for step, _ in rule) for rule in rules)
        words = max(1, -(-bits // 64))
        self.step, self.stay = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
        self.start, self.ends, at = np.zeros(words, np.uint64), [], 0
        for rule in rules:
            self.start[at // 64] |= self._bit(at)
            for step, run in rule:
                if step is not None:
                    at += 1
                    self.step[step, at // 64] |= self._bit(at)
                else:
                    self.stay[run, at // 64] |= self._bit(at)
            self.ends.append(at)
            at += 1

    @staticmethod
    def _bit(at: int) -> np.uint64:
        return np.uint64(1) << np.uint64(at % 64)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row for each text, a column for each rule."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        begins, state = offsets[:-1][order], np.tile(self.start, (len(order), 1))
        active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), side="right")
        for position, n in enumerate(active):
            c, d = data[begins[:n] + position], state[:n]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[c]) | (d & self.stay[c])
        out = np.zeros((len(order), len(self.ends)), bool)
        for k, end in enumerate(self.ends):
            out[order, k] = (state[:, end // 64] >> np.uint64(end % 64)) & np.uint64(1) > 0
        return out


def best_rule(host_rules: list[str], globs: list[str]):
    """UDF: the number of the longest host rule that matches, else of the first glob, else -1."""
    automaton = Automaton(host_rules, globs)
    by_length = sorted(range(len(host_rules)), key=lambda k: len(host_rules[k]))
    ranked = [*reversed(range(len(host_rules), len(host_rules) + len(globs))), *by_length]

    @F.arrow_udf("int")
    def best(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            hit = automaton.matches(*bytes_of(batch))
            found = np.full(len(batch), -1, np.int32)
            for k in ranked:
                found[hit[:, k]] = k
            yield pa.array(found)

    return best


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(df: DataFrame, url_col: str = "url", host_rules=HOST_RULES, block_globs=BLOCK_GLOBS) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (the host rule that decides, or null) and ``verdict``."""
    host_rules, globs = list(host_rules), list(block_globs)
    best = best_rule([rule for rule, _ in host_rules], globs)
    parts = df.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    found = free_names(parts, "best")[0]
    judged = parts.withColumn(found, best(F.concat(F.lit("."), "host", "path")))
    verdicts = [v for _, v in host_rules] + ["block"] * len(globs)
    rule, verdict = F.lit(None).cast("string"), F.lit("allow")
    for k, v in enumerate(verdicts):
        verdict = F.when(F.col(found) == k, F.lit(v)).otherwise(verdict)
        if k < len(host_rules):
            rule = F.when(F.col(found) == k, F.lit(host_rules[k][0])).otherwise(rule)
    return judged.withColumns({"rule": rule, "verdict": verdict}).drop(found)


def op4_url_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


_RULES = ", ".join(f"('{rule.partition('/')[0]}', '/{rule.partition('/')[2]}', '{verdict}')" for rule, verdict in HOST_RULES)
_GLOBS = " OR ".join(f"'.' || host || path LIKE '{glob.replace('*', '%')}'" for glob in BLOCK_GLOBS)
SQL = f"""WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES}),
parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
best AS (
  SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(rule_verdict, length(rule_host || rule_path)) AS found
  FROM parts LEFT JOIN rules ON ends_with('.' || host, '.' || rule_host) AND starts_with(path, rule_path)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(found, CASE WHEN {_GLOBS} THEN 'block' ELSE 'allow' END) AS verdict FROM best"""

QUERIES = {"op4_url_filter": (op4_url_filter, SQL)}
