"""SQL fragments shared by the oracle statements."""

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def key(x: str) -> str:
    """Squashed lower-case text."""
    return f"lower(trim(regexp_replace(coalesce({x}, ''), '\\s+', ' ', 'g')))"


def loose(x: str) -> str:
    """Squashed lower-case text without punctuation."""
    return (
        f"trim(regexp_replace(lower(coalesce({x}, '')), "
        "'[\\s.,:;!?()\\[\\]{}\"''/\\\\\\-]+', ' ', 'g'))"
    )


def text(s: str) -> str:
    """A string literal."""
    return "'" + s.replace("'", "''") + "'"


def any_match(x: str, patterns) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, {text(p)})" for p in patterns) + ")"


def first_match(x: str, named) -> str:
    whens = " ".join(f"WHEN regexp_matches({x}, {text(p)}) THEN {text(n)}" for n, p in named)
    return f"CASE {whens} END"


LINES = """
lines AS (
  SELECT doc_id, i - 1 AS ord, doc_id || '-' || (i - 1) AS block_id,
         (i - 1) // 5 + 1 AS page_number, line AS text
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents)
)"""


def page_spans(source: str = "lines", where: str = "true") -> str:
    """Block spans of the blocks that are not blank and satisfy ``where``."""
    t = strip("text")
    return f"""
  SELECT doc_id, page_number, block_id, ord, t,
         CAST(coalesce(sum(length(t) + 1) OVER (PARTITION BY doc_id, page_number ORDER BY ord
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "start",
         CAST(coalesce(sum(length(t) + 1) OVER (PARTITION BY doc_id, page_number ORDER BY ord
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(t) AS BIGINT) AS "end"
  FROM (SELECT *, {t} AS t FROM {source}) WHERE t <> '' AND {where}"""


def page_texts(source: str = "lines", where: str = "true") -> str:
    """Text of every page, empty where no block is left."""
    t = strip("text")
    return f"""
  SELECT doc_id, page_number,
         coalesce(string_agg(t, chr(10) ORDER BY ord) FILTER (WHERE t <> '' AND {where}), '') AS text
  FROM (SELECT *, {t} AS t FROM {source}) GROUP BY ALL"""
