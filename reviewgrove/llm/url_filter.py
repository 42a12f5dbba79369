"""Judge URLs by host and path rules and by a weighted vocabulary found with an Aho-Corasick automaton.

A rule names a host and a path; it fits the host and its subdomains when the path of the URL starts with its own, and
the longest fitting rule decides. Without one, terms of the vocabulary are counted in host, path and the rest of the URL,
with percent codes decoded and lower-cased, where they stand between characters that are neither letters nor digits. One strict term, or
SOFT_LIMIT different soft ones, block the URL. A URL whose codes are no UTF-8 is read as it stands.

Defined cases: a null URL, or one without ``://``, has an empty host and path and no rule; a null or empty URL is allowed; repeated
rows are judged one by one; of rules of equal length there is at most one per URL; very long URLs are read whole in linear time; an empty table gives an empty result. Other columns are carried.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote_to_bytes

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from reviewgrove.llm.batches import alongside

# (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# The vocabulary, in the four languages of the pages.
STRICT = (
    "porn", "porno", "pornos", "pornographie", "pornografie", "pornografia", "xxx", "escort", "escorts", "hentai", "camgirl", "sexcam",
    "casino", "viagra", "cialis", "warez", "keygen", "bordel", "bordell", "burdel", "putas",
)
SOFT = (
    "adult", "bet", "betting", "bonus", "cheap", "dating", "free", "hot", "jackpot", "loan", "nude", "poker", "pills", "sex", "win",
    "adulte", "gratuit", "rencontre", "rencontres", "pari", "paris-sportifs", "nue", "nues", "erotique",
    "kostenlos", "wette", "wetten", "nackt", "kredit", "erotik", "gewinnspiel", "singles",
    "adulto", "gratis", "apuesta", "apuestas", "desnuda", "desnudas", "citas", "prestamo", "erotica", "sexo", "sexe",
)
SOFT_LIMIT = 2
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
OUTPUTS = [
    T.StructField("host", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("verdict", T.StringType()),
    T.StructField("n_strict", T.LongType()),
    T.StructField("n_soft", T.LongType()),
]


def split_url(url: str) -> tuple[str, str]:
    """Host in lower case, and path."""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    end = min((at for mark in "/?#" if (at := rest.find(mark)) >= 0), default=len(rest))
    host, tail = rest[:end].translate(_LOWER), rest[end:]
    end = min((at for mark in "?#" if (at := tail.find(mark)) >= 0), default=len(tail))
    return host, tail[:end]


def rule_table(rules: Iterable[tuple[str, str, str]]) -> dict[str, list[tuple[str, str]]]:
    """Rules by host, the longest path first."""
    table: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in rules:
        table.setdefault(host, []).append((path, verdict))
    return {host: sorted(own, key=lambda rule: -len(rule[0])) for host, own in table.items()}


def fitting_rule(host: str, path: str, table: dict[str, list[tuple[str, str]]]) -> tuple[str, str] | None:
    """The longest rule that fits, as text, and its verdict. Only the host and what follows its dots are looked up."""
    best = None
    at = 0
    while at >= 0 and host:
        own = host[at:]
        for start, verdict in table.get(own, ()):
            if path.startswith(start):
                if best is None or len(own + start) > len(best[0]):
                    best = own + start, verdict
                break
        at = host.find(".", at) + 1 or -1
    return best


def automaton(strict: Iterable[str], soft: Iterable[str]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for terms, is_strict in ((soft, False), (strict, True)):
        for term in terms:
            built.add_word(term, (term, is_strict))
    built.make_automaton()
    return built


def decoded(url: str) -> str:
    if "%" not in url:
        return url
    try:
        return unquote_to_bytes(url).decode()
    except UnicodeDecodeError:
        return url


def count_terms(url: str, built: ahocorasick.Automaton) -> tuple[int, int]:
    """Occurrences of strict terms and number of different soft ones between boundaries."""
    low = decoded(url).translate(_LOWER)
    strict, soft = 0, set()
    for last, (term, is_strict) in built.iter(low):
        first = last - len(term) + 1
        if (first and low[first - 1].isalnum()) or (last + 1 < len(low) and low[last + 1].isalnum()):
            continue
        if is_strict:
            strict += 1
        else:
            soft.add(term)
    return strict, len(soft)


def judge(
    df: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with host, path, the deciding rule, the verdict and the counts of terms."""

    def start():
        table, built = rule_table(rules), automaton(strict, soft)

        def work(urls: pa.Array) -> list[pa.Array]:
            rows = []
            for text in urls.to_pylist():
                host, path = split_url(text)
                rule = fitting_rule(host, path, table)
                hard, mild = count_terms(text, built)
                own = "block" if hard or mild >= soft_limit else "allow"
                rows.append((host, path, rule and rule[0], rule[1] if rule else own, hard, mild))
            columns = zip(*rows)
            return [pa.array(c, t) for c, t in zip(columns, (*[pa.string()] * 4, pa.int64(), pa.int64()))]

        return work

    return alongside(df, url, OUTPUTS, start, carry)


def verdicts(df: DataFrame) -> DataFrame:
    return judge(df.select("page_id", "url"), carry=["page_id"])


def sql() -> str:
    """The same in SQL: one match per rule and term."""
    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    soft = " + ".join(f"regexp_matches(low, '{pattern(term)}')::BIGINT" for term in SOFT)
    strict = " + ".join(
        f"len(regexp_extract_all(regexp_replace(low, '([^\\p{{L}}\\p{{N}}])', '\\1\\1', 'g'), '{pattern(term)}'))" for term in STRICT
    )
    return f"""
WITH rules(h, p, v) AS (VALUES {rules}),
urls AS (SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages),
hosts AS (SELECT page_id, url, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM urls),
parts AS (SELECT page_id, url, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM hosts),
plain AS (SELECT page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  translate(coalesce(TRY(url_decode(url)), url), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM parts),
counted AS (SELECT page_id, host, path, {strict} AS n_strict, {soft} AS n_soft FROM plain),
fitting AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM plain JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN n_strict > 0 OR n_soft >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
  n_strict, n_soft FROM counted LEFT JOIN fitting USING (page_id)
"""


def pattern(term: str) -> str:
    return f"(^|[^\\p{{L}}\\p{{N}}]){term}([^\\p{{L}}\\p{{N}}]|$)"
