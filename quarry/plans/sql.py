"""SQL (DuckDB dialect) renderings of the bindings and operators, used as
independent oracles. Rendered from the same parameter tables as the Spark
plans (``quarry.params``)."""

from __future__ import annotations

from quarry import params
from quarry.functions import text as T

S = params.sql_str


def rx_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch)
    return "".join(out)


def normalize(x: str) -> str:
    e = f"regexp_replace({x}, {S(T.EMAIL_RE)}, '', 'g')"
    e = f"regexp_replace({e}, {S(T.URL_RE)}, '', 'g')"
    e = f"regexp_replace(strip_accents({e}), {S(T.NON_ASCII_RE)}, '', 'g')"
    e = f"regexp_replace({e}, {S(T.CONTROL_RE)}, '', 'g')"
    e = f"regexp_replace({e}, {S(T.NON_WORD_RE)}, '', 'g')"
    return f"trim(regexp_replace({e}, '\\s+', ' ', 'g'))"


def symbol_names(x: str) -> str:
    for sym, name in params.SYMBOLS:
        x = f"replace({x}, {S(sym)}, {S(name)})"
    return x


def lemmatized(x: str) -> str:
    lemma = "MAP {" + ", ".join(f"{S(a)}: {S(b)}" for a, b in params.LEMMAS) + "}"
    return f"array_to_string(list_transform(regexp_extract_all({x}, {S(T.LEMMA_TOKEN_RE)}), lambda w: coalesce({lemma}[lower(w)], w)), ' ')"


def period_case(ts: str) -> str:
    parts = [f"WHEN {ts} BETWEEN TIMESTAMP {S(lo)} AND TIMESTAMP {S(hi)} THEN {S(n)}"
             for n, lo, hi in params.PERIODS]
    return "CASE " + " ".join(parts) + " END"


def word_map(pairs) -> str:
    return "MAP {" + ", ".join(f"{S(w)}: CAST({v!r} AS DOUBLE)" for w, v in pairs) + "}"


def let(name: str, value: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def sentiment(x: str) -> str:
    """The word rules, one word at a time: w words, t lower-cased, m capitals and
    others, k place of the first contrast word (0: none)."""
    lex, boost, p = word_map(params.LEXICON), word_map(params.BOOSTERS), params
    in_lex, in_boost = params.sql_list([w for w, _ in p.LEXICON]), params.sql_list([w for w, _ in p.BOOSTERS])
    at = "i - CAST(d AS INTEGER)"
    sign = "CASE WHEN v < 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END"
    fade = "[" + ", ".join(f"{f}::DOUBLE" for f in p.FADE) + "][CAST(d AS INTEGER)]"
    strength = f"({boost}[t[{at}]] + CASE WHEN m AND w[{at}] = upper(w[{at}]) THEN {p.CAPS}::DOUBLE ELSE 0.0::DOUBLE END)"
    moved = f"(v + CASE WHEN list_contains({in_boost}, t[{at}]) THEN {sign} * {strength} * {fade} ELSE 0.0::DOUBLE END)"
    step = (f"CASE WHEN {at} < 1 OR list_contains({in_lex}, t[{at}]) THEN v "
            f"WHEN list_contains({params.sql_list(p.NEGATIONS)}, t[{at}]) THEN {moved} * {p.NEGATION_SCALAR}::DOUBLE ELSE {moved} END")
    own = let("v", f"{lex}[a]", f"v + CASE WHEN m AND w[i] = upper(w[i]) THEN ({sign}) * {p.CAPS}::DOUBLE ELSE 0.0::DOUBLE END")
    weight = "CASE WHEN k > 0 AND i < k THEN 0.5::DOUBLE WHEN k > 0 AND i > k THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END"
    value = (f"CASE WHEN list_contains({in_lex}, a) AND NOT list_contains({in_boost}, a) THEN "
             f"list_reduce([1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE], lambda v, d: {step}, {own}) * {weight} ELSE 0.0::DOUBLE END")
    total = f"coalesce(list_sum(list_transform(t, lambda a, i: {value})), 0.0::DOUBLE)"
    but = f"coalesce(list_position(list_transform(t, lambda a: list_contains({params.sql_list(p.CONTRAST)}, a)), true), 0)"
    up = "len(list_filter(w, lambda a: a = upper(a)))"
    total = let("k", but, total)
    total = let("m", f"{up} > 0 AND {up} < len(w)", total)
    total = let("t", "list_transform(w, lambda a: lower(a))", total)
    total = let("w", f"regexp_extract_all({x}, '[A-Za-z]+')", total)
    n = {c: f"(length({x}) - length(replace({x}, '{c}', '')))" for c in "!?"}
    marks = (f"(least({n['!']}, 4) * {p.SHOUT}::DOUBLE + CASE WHEN {n['?']} > 3 THEN {p.ASK_MOST}::DOUBLE "
             f"WHEN {n['?']} > 1 THEN {n['?']} * {p.ASK}::DOUBLE ELSE 0.0::DOUBLE END)")
    stressed = let("v", total, f"CASE WHEN v = 0 THEN v ELSE v + ({sign}) * {marks} END")
    return let("v", stressed, f"round(v / sqrt(v * v + {p.VADER_ALPHA}::DOUBLE), 4)")


def polarity(x: str, th: float = params.SENTIMENT_THRESHOLD) -> str:
    return f"CASE WHEN {x} >= {th} THEN 'positive' WHEN {x} <= {-th} THEN 'negative' ELSE 'neutral' END"


def replace_aliases(x: str) -> str:
    e = f"lower({x})"
    for alias, canon in params.alias_lookup():
        e = f"regexp_replace({e}, {S(chr(92) + 'b' + rx_escape(alias) + chr(92) + 'b')}, {S(canon)}, 'g')"
    return e


def tokenize(x: str) -> str:
    stop = params.sql_list(params.STOP_WORDS)
    return (f"list_filter(regexp_extract_all(lower({x}), {S(T.TOKEN_RE)}), "
            f"lambda t: length(t) >= 3 AND NOT list_contains({stop}, t))")


def ngrams2(toks: str) -> str:
    return (f"list_concat({toks}, list_transform(range(1, len({toks})), "
            f"lambda i: {toks}[i] || '_' || {toks}[i + 1]))")


UNITS_RAW = """
units_raw AS (
  SELECT c.conv_id * 1000 + c.turn AS unit_id, c.conv_id AS post_id, c.turn,
         CASE WHEN c.turn = 0 THEN 'title' ELSE 'comment' END AS kind,
         c.role AS author, c.text AS raw_text,
         CAST(length(c.text) % 100 - 10 AS BIGINT) AS score,
         CAST(o.o_orderdate AS TIMESTAMP) + c.conv_id * INTERVAL 1 HOUR AS created_utc
  FROM conversations c LEFT JOIN orders o ON o.o_orderkey = c.conv_id
)"""


def units_ctes() -> str:
    """CTEs ``units_raw``, ``units_n`` and ``units`` (period-tagged)."""
    return f"""{UNITS_RAW},
units_n AS (
  SELECT unit_id, post_id, turn, kind, author, score, created_utc,
         {period_case('created_utc')} AS period, {normalize('raw_text')} AS text
  FROM units_raw
),
units AS (
  SELECT *, {sentiment('text')} AS sentiment FROM units_n WHERE period IS NOT NULL
)"""


def terms_ctes() -> str:
    """Adds ``uterms`` (unit, terms) and ``term_docs`` and ``word_stats``."""
    return f"""{units_ctes()},
utok AS (SELECT *, {tokenize(replace_aliases('text'))} AS toks FROM units WHERE text <> ''),
uterms AS (SELECT *, {ngrams2('toks')} AS terms FROM utok),
term_occ AS (SELECT period, unit_id, sentiment, text, unnest(terms) AS token FROM uterms),
term_docs AS (SELECT period, unit_id, sentiment, token, count(*) AS n FROM term_occ GROUP BY ALL),
word_stats AS (
  SELECT period, token, CAST(sum(n) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS n_docs,
         CAST(sum(CAST(round(sentiment * 10000) AS BIGINT)) AS DOUBLE) / count(sentiment) / 10000.0::DOUBLE AS avg_sentiment
  FROM term_docs GROUP BY period, token
)"""


def mentions_list(x: str, table=None) -> str:
    from quarry.operators.mentions import alias_table
    table = alias_table() if table is None else table
    items = []
    for ent, aliases in sorted(table, key=lambda t: t[0]):
        cond = " OR ".join(f"contains(lower({x}), {S(a)})" for a in aliases)
        items.append(f"CASE WHEN {cond} THEN {S(ent)} END")
    return f"list_filter([{', '.join(items)}], lambda e: e IS NOT NULL)"


def mention_ctes() -> str:
    return f"""{units_ctes()},
um AS (SELECT *, {mentions_list('text')} AS mentions FROM units),
mrows AS (SELECT period, unit_id, kind, score, sentiment, unnest(mentions) AS entity FROM um),
upairs AS (SELECT period, score, sentiment, unnest(flatten(list_transform(range(1, len(mentions)),
              lambda i: list_transform(range(i + 1, len(mentions) + 1),
                 lambda j: {{'src': mentions[i], 'dst': mentions[j]}})))) AS pair
           FROM um WHERE len(mentions) >= 2),
edges AS (SELECT period, pair.src AS src, pair.dst AS dst, CAST(sum(score) AS BIGINT) AS weight,
                 CAST(count(*) AS BIGINT) AS num_mentions,
                 CAST(sum(CAST(round(sentiment * 10000) AS BIGINT)) AS DOUBLE) / count(sentiment) / 10000.0::DOUBLE AS average_sentiment
          FROM upairs GROUP BY ALL),
sym AS (SELECT period, src AS node, dst AS neighbor, weight, average_sentiment FROM edges
        UNION ALL SELECT period, dst, src, weight, average_sentiment FROM edges),
deg AS (SELECT period, node, CAST(count(*) AS BIGINT) AS degree FROM sym GROUP BY ALL),
nsent AS (SELECT period, entity, CAST(sum(CAST(round(sentiment * 10000) AS BIGINT)) AS DOUBLE) / count(sentiment) / 10000.0::DOUBLE AS avg_sentiment,
                 CAST(count(*) AS BIGINT) AS mentions FROM mrows GROUP BY ALL)"""


def bfs_ctes(edges_cte: str = "edges", key: str = "period") -> str:
    """``gsym`` (symmetric edges) and ``apsp`` (BFS levels with path counts)
    over an edge CTE (key, src, dst)."""
    return f"""gsym AS (SELECT DISTINCT {key} AS g, src, dst FROM {edges_cte} WHERE src <> dst
              UNION SELECT DISTINCT {key}, dst, src FROM {edges_cte} WHERE src <> dst),
apsp AS (WITH RECURSIVE bfs(g, s, v, d, sigma) USING KEY (g, s, v) AS (
    SELECT DISTINCT g, src, src, 0, CAST(1 AS BIGINT) FROM gsym
    UNION
    (SELECT f.g, f.s, x.dst, min(f.d) + 1, CAST(sum(f.sigma) AS BIGINT) FROM bfs f JOIN gsym x ON x.g = f.g AND x.src = f.v
     WHERE NOT EXISTS (SELECT 1 FROM recurring.bfs r WHERE r.g = f.g AND r.s = f.s AND r.v = x.dst)
     GROUP BY f.g, f.s, x.dst))
  SELECT * FROM bfs)"""
