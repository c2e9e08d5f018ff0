"""Phonetic codes and longest common subsequences as recursive DuckDB SQL: second implementations of the Arrow kernels."""

from __future__ import annotations

VOWELS = "('A', 'E', 'I', 'O', 'U', 'Y')"

#: A letter at place i of l: itself a, the next ones b and d, the one before z, the two and three before it, and the letters left.
_VIEW = """SELECT *, substr(l, i, 1) AS a, substr(l, i + 1, 1) AS b, substr(l, i + 2, 1) AS d, CASE WHEN i > 1 THEN substr(l, i - 1, 1) ELSE '' END AS z,
        CASE WHEN i > 2 THEN substr(l, i - 2, 2) ELSE '' END AS zz, CASE WHEN i > 3 THEN substr(l, i - 3, 3) ELSE '' END AS zzz, length(l) - i + 1 AS rest"""

#: Condition, letters taken, primary and secondary code; the first that holds counts.
_STEPS = [
    ("i = 1 AND ((a IN ('G', 'K', 'P') AND b = 'N') OR a || b IN ('WR', 'PS'))", "1", "", ""),
    ("i = 1 AND a = 'X'", "1", "S", "S"),
    (f"i = 1 AND a IN {VOWELS}", "1", "A", "A"),
    (f"a IN {VOWELS}", "1", "", ""),
    ("a = 'B' AND z = 'M' AND rest = 1", "1", "", ""),
    ("a = 'B'", "1 + (b IN ('H', 'B'))::INT", "P", "P"),
    ("a = 'C' AND b = 'Z'", "2", "S", "X"),
    ("a = 'C' AND b = 'H'", "2", "X", "X"),
    ("a = 'C' AND b = 'I' AND d = 'A'", "3", "X", "X"),
    ("a = 'C' AND b = 'C' AND d IN ('I', 'E', 'H')", "3", "X", "KS"),
    ("a = 'C' AND b IN ('I', 'E', 'Y')", "1", "S", "S"),
    ("a = 'C'", "1 + (b IN ('K', 'G', 'Q', 'C'))::INT", "K", "K"),
    ("a = 'D' AND b = 'G' AND d IN ('I', 'E', 'Y')", "2", "J", "J"),
    ("a = 'D' AND b IN ('T', 'D', 'H')", "2", "T", "T"),
    ("a = 'D' AND zz = 'IE' AND rest = 1", "1", "", ""),
    ("a = 'D'", "1", "T", "T"),
    ("a = 'F'", "1 + (b = 'F')::INT", "F", "F"),
    (f"a = 'G' AND b = 'H' AND (i = 1 OR d IN {VOWELS})", "2", "K", "K"),
    ("a = 'G' AND b = 'H'", "2", "", ""),
    ("a = 'G' AND b = 'N'", "2", "K", "N"),
    ("a = 'G' AND b IN ('I', 'E', 'Y')", "1", "J", "K"),
    ("a = 'G'", "1 + (b = 'G')::INT", "K", "K"),
    (f"a = 'H' AND b IN {VOWELS} AND (i = 1 OR z IN {VOWELS})", "1", "H", "H"),
    ("a = 'J'", "1 + (b = 'J')::INT", "J", "H"),
    ("a = 'K' AND b = 'S' AND d = 'H'", "3", "KS", "KS"),
    ("a = 'K'", "1 + (b IN ('H', 'K'))::INT", "K", "K"),
    ("a = 'L'", "1 + (b = 'L')::INT", "L", "L"),
    ("a = 'M'", "1 + (b = 'M')::INT", "M", "M"),
    ("a = 'N'", "1 + (b = 'N')::INT", "N", "N"),
    ("a = 'P' AND b = 'H'", "2", "F", "F"),
    ("a = 'P'", "1 + (b IN ('P', 'B'))::INT", "P", "P"),
    ("a = 'Q'", "1 + (b = 'Q')::INT", "K", "K"),
    ("a = 'R'", "1 + (b = 'R')::INT", "R", "R"),
    ("a = 'S' AND b = 'H'", "2", "X", "X"),
    ("a = 'S' AND b = 'I' AND d IN ('O', 'A')", "3", "S", "X"),
    ("a = 'S' AND b = 'C' AND d IN ('I', 'E', 'Y')", "3", "S", "S"),
    ("a = 'S' AND b = 'C'", "2", "SK", "SK"),
    ("a = 'S'", "1 + (b = 'S')::INT", "S", "S"),
    ("a = 'T' AND ((b = 'I' AND d IN ('O', 'A')) OR (b = 'C' AND d = 'H'))", "3", "X", "X"),
    ("a = 'T' AND b = 'H'", "2", "0", "T"),
    ("a = 'T' AND b = 'T'", "2", "T", "T"),
    ("a = 'T' AND rest = 1 AND (zzz = 'AUL' OR z IN ('O', 'E'))", "1", "", "T"),
    ("a = 'T'", "1", "T", "T"),
    ("a = 'V'", "1 + (b = 'V')::INT", "F", "F"),
    (f"a = 'W' AND z IN {VOWELS} AND b NOT IN {VOWELS}", "1", "", ""),
    (f"a = 'W' AND b IN {VOWELS}", "1", "A", "F"),
    ("a = 'X' AND rest = 1 AND zz IN ('AU', 'OU')", "1", "", "KS"),
    ("a = 'X'", "1", "KS", "KS"),
    ("a = 'Z' AND b = 'H'", "2", "J", "J"),
    ("a = 'Z'", "1 + (b = 'Z')::INT", "S", "TS"),
]


def phonetic(words: str, letters: str) -> str:
    """Tables sounded_* that end in codes (w, code, other): both codes of the words w that `words` selects; letters is their A-Z."""
    cases = " ".join(f"WHEN {test} THEN {{'n': {n}, 'p': '{p}', 's': '{s}'}}" for test, n, p, s in _STEPS)
    return f"""sounded_words AS (SELECT w, {letters} AS l FROM ({words})
), sounded_scan(w, l, i, np, ns, p, s) AS (
  SELECT w, l, 1, 0, 0, '', '' FROM sounded_words
  UNION ALL SELECT w, l, i + r.n, np + (r.p <> '')::INT, ns + (r.s <> '')::INT, p || r.p, s || r.s FROM (
    SELECT *, CASE {cases} ELSE {{'n': 1, 'p': '', 's': ''}} END AS r FROM ({_VIEW} FROM sounded_scan WHERE i <= length(l) AND least(np, ns) < 4))
), codes AS (SELECT w, substr(p, 1, 4) AS code, substr(s, 1, 4) AS other FROM sounded_scan WHERE i > length(l) OR least(np, ns) >= 4)"""


def lcs(pairs: str) -> str:
    """Tables lcs_* that end in lcs (s, t, n): the length of the longest common subsequence of the pairs (s, t) that `pairs` selects."""
    return f"""lcs_run(s, t, k, line) AS (
  SELECT s, t, 0, list_transform(range(length(t) + 1), lambda x: 0::BIGINT) FROM (SELECT DISTINCT s, t FROM ({pairs}) WHERE s <> '' AND t <> '')
  UNION ALL SELECT s, t, k + 1, list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])) FROM (
    SELECT s, t, k, list_transform(range(1, len(line) + 1), lambda j: CASE WHEN j = 1 THEN 0::BIGINT ELSE greatest(line[j], line[j - 1] + (substr(t, CAST(j - 1 AS INT), 1) = substr(s, k + 1, 1))::BIGINT) END) AS c
    FROM lcs_run WHERE k < length(s))
), lcs AS (SELECT s, t, list_max(line) AS n FROM lcs_run WHERE k = length(s))"""
