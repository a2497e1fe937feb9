"""Quality rules, line first: every line is judged by itself, failing lines go, and a document that loses too much goes.

Rules of a line (words are runs of anything but ASCII white space):

- *blank* lines are neutral: they are kept and carry no words;
- *symbols*: more than ``symbol_percent`` of the words hold one of ``[#*$%&|<>]``;
- *navigation*: at least ``nav_separators`` words are only separators, and they are ``nav_percent`` of all words;
- *shouting*: of at least ``shout_words`` words, more than ``shout_percent`` are upper case and end in an exclamation mark;
- *punctuation*: a line of at least ``open_words`` words that does not end in closing punctuation;
- *boilerplate*: one of the phrases of ``BOILERPLATE`` in a line of at most ``boilerplate_words`` words;
- *repeats*: a line with a word that equals an earlier line of the document.

``clean_lines`` returns the cleaned text; a document is kept if the base rules hold and the failing lines carry at most
``max_lost_percent`` of its word bytes. A null or empty text has no words and fails the base rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.common import map_texts, table

SYMBOLS = b"#*$%&|<>"
_SYMBOL = re.compile(rb"[#*$%&|<>]")
_NOT_SYMBOL = bytes(c for c in range(256) if c not in SYMBOLS)
_SEPARATORS = frozenset(s.encode() for s in ("|", ">", ">>", "»", "›", "•", "·", "/", "-", "–", "*", "::", "<", "«"))
_CLOSING = tuple(s.encode() for s in (".", "!", "?", "…", ":", ";", "。", "！", "？", '."', '!"', '?"', ".”", ".»", ".)", ")", "}", ",", "\""))
#: Phrases of notices and page furniture, in the lower case in which lines are compared.
BOILERPLATE = tuple(s.encode() for s in (
    "all rights reserved", "cookie policy", "accept cookies", "we use cookies", "privacy policy", "terms of use",
    "terms of service", "enable javascript", "click here", "read more", "sign up", "log in", "subscribe to our",
    "share this", "skip to content", "lorem ipsum",
))


@dataclass(frozen=True)
class LineRules:
    symbol_percent: int = 30
    nav_separators: int = 3
    nav_percent: int = 15
    shout_words: int = 2
    shout_percent: int = 50
    open_words: int = 40
    boilerplate_words: int = 30
    max_lost_percent: int = 50


def line_fails(line: bytes, words: list[bytes], rules: LineRules) -> bool:
    """The verdict on one line with at least one word (repeats are judged by the caller)."""
    n = len(words)
    if _SYMBOL.search(line):
        if 100 * sum(1 for w in words if _SYMBOL.search(w) and w not in _SEPARATORS) > rules.symbol_percent * n:
            return True
    separators = sum(map(_SEPARATORS.__contains__, words))
    if separators >= rules.nav_separators and 100 * separators >= rules.nav_percent * n:
        return True
    if b"!" in line and n >= rules.shout_words:
        if 100 * sum(1 for w in words if w.endswith(b"!") and w.upper() == w and w.lower() != w) > rules.shout_percent * n:
            return True
    if n >= rules.open_words and not words[-1].endswith(_CLOSING):
        return True
    if n <= rules.boilerplate_words:
        lower = line.lower()
        if any(p in lower for p in BOILERPLATE):
            return True
    return False


def repeated_window_words(ids: np.ndarray, size: int = 8) -> int:
    """Words covered by windows of ``size`` (a power of two) words that occur twice or more; exact, by doubling ids."""
    n = len(ids)
    if n <= size:
        return 0
    ranks, width = ids, 1
    while width < size:
        pairs = ranks[:-width] * np.int64(n + 1) + ranks[width:]
        ranks = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    again = np.bincount(ranks)[ranks] > 1
    if not again.any():
        return 0
    step = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    step[at] += 1
    np.subtract.at(step, at + size, 1)
    return int(np.count_nonzero(np.cumsum(step[:-1])))


def judge(text: bytes | None, rules: LineRules) -> tuple:
    """Counts, verdicts and the cleaned text of one document."""
    text = text or b""
    words = text.split()
    n_words = len(words)
    joined = b"".join(words)
    word_chars = len(joined.decode("utf-8", "replace"))
    n_symbols = len(joined.translate(None, _NOT_SYMBOL))
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n_words)
    repeat_words = repeated_window_words(ids)
    seen: set[bytes] = set()
    kept, n_lines, dup_lines, lost_lines, lost_bytes = [], 0, 0, 0, 0
    for line in text.split(b"\n"):
        parts = line.split()
        if not parts:
            kept.append(line)
            continue
        n_lines += 1
        repeat = line in seen
        dup_lines += repeat
        seen.add(line)
        if repeat or line_fails(line, parts, rules):
            lost_lines += 1
            lost_bytes += sum(map(len, parts))
        else:
            kept.append(line)
    failed = n_words < 20 or 100 * repeat_words > 30 * n_words
    keep = not failed and 100 * lost_bytes <= rules.max_lost_percent * len(joined)
    return (n_words, word_chars, n_symbols, dup_lines, repeat_words, failed, keep, n_lines, lost_lines,
            lost_bytes, b"\n".join(kept))


_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines",
            "n_failed_lines", "lost_bytes", "clean_text")
_DDL = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "kept boolean, n_lines long, n_failed_lines long, lost_bytes long")


def clean_lines(docs: DataFrame, rules: LineRules = LineRules(), with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept and (``with_text``) the text without failing lines.

    Rows with a null or repeated doc_id are judged one by one; other columns of ``docs`` are not read.
    """
    names = _COLUMNS if with_text else _COLUMNS[:-1]

    def block(texts: list) -> dict:
        rows = [judge(t, rules) for t in texts]
        columns = dict(zip(names, map(list, zip(*rows))))
        if with_text:
            columns["clean_text"] = [t.decode("utf-8", "replace") for t in columns["clean_text"]]
        return columns

    return map_texts(docs, block, _DDL + (", clean_text string" if with_text else ""))


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents"), with_text=False)


_R = LineRules()


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.decode().replace("'", "''") + "'" for v in values) + "]"


#: Case is that of ASCII letters (as in ``bytes.upper``): translate, not upper.
_UPPER = "translate({}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words FROM docs),
pos AS (SELECT doc_id, unnest(generate_series(1, len(words) - 7)) AS p, words FROM split WHERE len(words) >= 8),
win AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, array_to_string(words[p:p + 7], ' ')) AS c FROM pos),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
  SELECT doc_id, unnest(generate_series(p, p + 7)) AS q FROM win WHERE c > 1) GROUP BY doc_id),
cut AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM docs),
raw AS (SELECT doc_id, unnest(parts) AS line, unnest(generate_series(1, len(parts))) AS line_no FROM cut),
lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY line_no) > 1 AS again,
    list_filter(regexp_split_to_array(line, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS ws
  FROM raw WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]')),
counted AS (
  SELECT *, len(ws) AS n, len(list_filter(ws, lambda w: list_contains({_sql_list(sorted(_SEPARATORS))}, w))) AS seps,
    len(list_filter(ws, lambda w: regexp_matches(w, '[#*$%&|<>]')
      AND NOT list_contains({_sql_list(sorted(_SEPARATORS))}, w))) AS syms,
    len(list_filter(ws, lambda w: suffix(w, '!') AND {_UPPER.format("w")} = w AND {_LOWER.format("w")} <> w)) AS shouts,
    len(list_filter({_sql_list(_CLOSING)}, lambda c: suffix(ws[-1], c))) > 0 AS closed,
    len(list_filter({_sql_list(BOILERPLATE)}, lambda c: contains({_LOWER.format("line")}, c))) > 0 AS furniture,
    strlen(array_to_string(ws, '')) AS bytes
  FROM lines),
judged AS (
  SELECT doc_id, again, bytes, again OR 100 * syms > {_R.symbol_percent} * n
    OR (seps >= {_R.nav_separators} AND 100 * seps >= {_R.nav_percent} * n)
    OR (n >= {_R.shout_words} AND 100 * shouts > {_R.shout_percent} * n) OR (n >= {_R.open_words} AND NOT closed)
    OR (n <= {_R.boilerplate_words} AND furniture) AS bad
  FROM counted),
per_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (bad) AS n_bad, count(*) FILTER (again) AS n_dup,
    coalesce(sum(bytes) FILTER (bad), 0) AS lost FROM judged GROUP BY doc_id),
base AS (
  SELECT s.doc_id, words, coalesce(l.n_dup, 0) AS n_dup, coalesce(rep.n, 0) AS n_rep, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_bad, 0) AS n_bad, coalesce(lost, 0) AS lost,
    len(words) < 20 OR 100 * coalesce(rep.n, 0) > 30 * len(words) AS base_failed
  FROM split s LEFT JOIN rep ON s.doc_id = rep.doc_id LEFT JOIN per_doc l ON s.doc_id = l.doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, len(array_to_string(words, ''))::BIGINT AS word_chars,
  len(regexp_replace(array_to_string(words, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  n_dup::BIGINT AS n_dup_lines, n_rep::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost <= {_R.max_lost_percent} * strlen(array_to_string(words, '')) AS kept,
  n_lines::BIGINT AS n_lines, n_bad::BIGINT AS n_failed_lines, lost::BIGINT AS lost_bytes
FROM base
"""
