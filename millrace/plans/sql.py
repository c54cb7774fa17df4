"""Fragments of DuckDB SQL for the queries' twins. Patterns are RE2: no look-around, and \\b is spelled out for Unicode."""


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def wc(normalized: str) -> str:
    return f"(CASE WHEN {normalized} = '' THEN 0 ELSE len(string_split({normalized}, ' ')) END)"


def re2(pattern: str) -> str:
    """\\b at the start or end of a pattern or group becomes an explicit boundary."""
    before, after = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
    head = pattern.startswith(r"\b")
    body = pattern[2:] if head else pattern
    tail = body.endswith(r"\b")
    body = body[:-2] if tail else body
    assert r"\b" not in body, pattern
    return (before if head else "") + body + (after if tail else "")


def hit(c: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({c}, {q((f'(?{flags})' if flags else '') + re2(pattern))})"


def hits(c: str, patterns: list[str], flags: str = "") -> str:
    return "(" + " + ".join(f"{hit(c, p, flags)}::INT" for p in patterns) + ")"


def any_hit(c: str, patterns: list[str], flags: str = "") -> str:
    return "(" + " OR ".join(hit(c, p, flags) for p in patterns) + ")"


def contains(c: str, lexicon: list[str]) -> str:
    return "(" + " + ".join(f"contains({c}, {q(w)})::INT" for w in lexicon) + ")"


def sentences(c: str, strict: bool) -> str:
    """Look-around free split: the mark ends a sentence, chr(1) stands for the split."""
    if strict:
        return rf"string_split(regexp_replace({c}, '([.!?])\s+([A-ZÀ-Ü])', '\1' || chr(1) || '\2', 'g'), chr(1))"
    return rf"string_split(regexp_replace({c}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"


def packed(source: str, least: int, most: int, tail: str = "") -> str:
    """CTEs after source(doc_id, ss): greedy packing by recursion; result g(doc_id, grp, n, t) with every group, short tails too."""
    return f"""
w AS MATERIALIZED (SELECT doc_id, i, ss[i] AS s, {wc("ss[i]")} AS n FROM (SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM {source})),
r AS (SELECT doc_id, i, n AS total, 0 AS grp FROM w WHERE i = 1
      UNION ALL
      SELECT w.doc_id, w.i, CASE WHEN r.total + w.n > {most} AND r.total >= {least} THEN w.n ELSE r.total + w.n END,
             CASE WHEN r.total + w.n > {most} AND r.total >= {least} THEN r.grp + 1 ELSE r.grp END
      FROM r JOIN w ON w.doc_id = r.doc_id AND w.i = r.i + 1),
g AS (SELECT doc_id, grp, sum(w.n) AS n, string_agg(w.s, ' ' ORDER BY w.i) AS t FROM r JOIN w USING (doc_id, i) GROUP BY doc_id, grp)"""
