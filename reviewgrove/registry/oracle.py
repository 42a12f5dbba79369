"""SQL counterparts of the queries, for an engine with RE2 regular expressions."""

from __future__ import annotations

# The English stop words that ship with Spark, written out so that the SQL needs neither a session nor
# Spark's files. A test compares them to what a session loads.
STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is are
    was were be been being have has had having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above below to from up down in out on
    off over under again further then once here there when where why how all any both each few more most other
    some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
    we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
    mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
    would
""".split()

# The patterns of the cleaning steps, in the order of use. Written out, as the rules below, so that the SQL does
# not follow a mistake in what it is compared with.
REPLACED = (r"\S+@\S+\s", "\n|\t", r"\S*\d+\S*", r"\s\W*\w\W*\s", r"\W+")
# Irregular words, and the suffixes with their replacements, of the common variant of Porter's algorithm.
IRREGULAR = """
    sky sky skies sky dying die lying lie tying tie news news innings inning inning inning outings outing outing outing
    cannings canning canning canning howe howe proceed proceed exceed exceed succeed succeed
""".split()
SECOND = """
    ational ate tional tion enci ence anci ance izer ize bli ble entli ent eli e ousli ous ization ize ation ate ator ate
    alism al iveness ive fulness ful ousness ous aliti al iviti ive biliti ble fulli ful logi log
""".split()
THIRD = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
FOURTH = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()
# The largest number of terms of the fitted stage.
VOCAB_SIZE = 1 << 18
LABEL = "1 + 2 * quality + (1 - toxic)"
RATED = "documents JOIN labels USING (doc_id)"


def cleaned(text: str, steps: int = 6) -> str:
    """The first ``steps`` cleaning steps on an SQL expression."""
    for pattern in REPLACED[:steps]:
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return f"lower({text})" if steps > len(REPLACED) else text


def stop_list() -> str:
    """The stop words as SQL rows."""
    quoted = ("('" + word.replace("'", "''") + "')" for word in STOP_WORDS)
    return f"stops(word) AS (VALUES {', '.join(quoted)})"


def words_cte(source: str = "documents", stops: bool = True, label: bool = False) -> str:
    """CTEs up to ``words(doc_id, [label,] w)``: the words of every text as a list."""
    kept = f"doc_id, {LABEL} AS label" if label else "doc_id"
    names = "doc_id, label" if label else "doc_id"
    split = f"list_filter(string_split({cleaned('text')}, ' '), lambda x: x <> '')"
    texts = f"texts AS (SELECT {kept}, {split} AS w FROM {source})"
    if not stops:
        return f"{texts}, words AS (SELECT {names}, w FROM texts)"
    return (
        f"{stop_list()}, {texts}, "
        f"every AS (SELECT {names}, unnest(w) AS term, unnest(range(len(w))) AS pos FROM texts), "
        f"words AS (SELECT {names}, list(term ORDER BY pos) AS w FROM every "
        "WHERE term NOT IN (SELECT word FROM stops) GROUP BY ALL)"
    )


def positions(words: str) -> str:
    return (
        f"WITH {words}, each AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w)))::INT AS pos FROM words) "
        "SELECT doc_id, pos, term FROM each"
    )


def cells_cte(words: str, label: bool = False) -> str:
    names = "doc_id, label" if label else "doc_id"
    return (
        f"{words}, cells AS (SELECT {names}, term, count(*)::INT AS tf FROM "
        f"(SELECT {names}, unnest(w) AS term FROM words) GROUP BY ALL)"
    )


def terms_cte(
    cells: str, having: str = "df >= 10", total: str = "SELECT count(*) FROM documents", size: int | None = None
) -> str:
    cut = "" if size is None else f" ORDER BY corpus_count DESC, term LIMIT {size}"
    return (
        f"{cells}, total AS ({total}), every_term AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS corpus_count "
        f"FROM cells GROUP BY term), terms AS (SELECT *, ln(((SELECT * FROM total) + 1.0) / (df + 1.0)) AS idf "
        f"FROM every_term WHERE {having}{cut})"
    )


def weights(terms: str, columns: str = "doc_id, term, tf, round(tf * idf, 9) AS tfidf") -> str:
    return f"WITH {terms} SELECT {columns} FROM cells JOIN terms USING (term)"


# Stemming. Every step is a CTE over the distinct words: ``w`` is the word so far, ``s`` the same in "c" and "v".

_SOUND = (
    "list_reduce(string_split({w}, ''), lambda acc, ch: acc || CASE WHEN ch IN ('a', 'e', 'i', 'o', 'u') "
    "OR (ch = 'y' AND right(acc, 1) = 'c') THEN 'v' ELSE 'c' END, '')"
)


def _measure(cut: int, extra: int = 0) -> str:
    """Measure of the word without its last ``cut`` letters."""
    part = f"left(s, length(s) - {cut - extra})"
    return f"((length({part}) - length(replace({part}, 'vc', ''))) // 2)"


def _stem_of(cut: int) -> str:
    return f"left(w, length(w) - {cut})"


def _short(word: str, sound: str) -> str:
    return f"({sound} = 'vc' OR (right({sound}, 3) = 'cvc' AND right({word}, 1) NOT IN ('w', 'x', 'y')))"


def _step(name: str, before: str, case: str) -> str:
    return (
        f"{name} AS (SELECT term, w, {_SOUND.format(w='w')} AS s FROM "
        f"(SELECT term, CASE {case} ELSE w END AS w FROM {before}))"
    )


def _suffixes(rules: dict[str, str], least: int, extra_l: tuple[str, ...] = ()) -> str:
    """The longest matching suffix decides; it is replaced if the measure in front is large enough."""
    arms = []
    for suffix in sorted(rules, key=len, reverse=True):
        n = len(suffix)
        test = f"{_measure(n, 1 if suffix in extra_l else 0)} >= {least}"
        if suffix == "ion":
            test += f" AND right({_stem_of(3)}, 1) IN ('s', 't')"
        arms.append(f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {test} THEN {_stem_of(n)} || '{rules[suffix]}' ELSE w END")
    return " ".join(arms)


def stems_cte(terms: str) -> str:
    """CTEs up to ``stems(term, stem)`` from a query that gives distinct ``term``."""
    irregular = ", ".join(f"('{word}', '{stem}')" for word, stem in zip(IRREGULAR[::2], IRREGULAR[1::2]))
    rules_2 = dict(zip(SECOND[::2], SECOND[1::2]))
    mended = (
        "CASE WHEN right(p, 2) IN ('at', 'bl', 'iz') THEN p || 'e' "
        "WHEN length(p) > 1 AND right(p, 1) = left(right(p, 2), 1) AND right(ps, 1) = 'c' "
        "THEN CASE WHEN right(p, 1) IN ('l', 's', 'z') THEN p ELSE left(p, length(p) - 1) END "
        f"WHEN (length(ps) - length(replace(ps, 'vc', ''))) // 2 = 1 AND {_short('p', 'ps')} THEN p || 'e' ELSE p END"
    )
    past = (
        "SELECT term, w, s, CASE WHEN ends_with(w, 'ied') OR ends_with(w, 'eed') THEN 0 "
        "WHEN ends_with(w, 'ed') AND contains(left(s, length(s) - 2), 'v') THEN 2 "
        "WHEN ends_with(w, 'ing') AND contains(left(s, length(s) - 3), 'v') THEN 3 ELSE 0 END AS cut FROM k1a"
    )
    return ", ".join(
        [
            f"irregular(term, stem) AS (VALUES {irregular})",
            f"k0 AS (SELECT term, term AS w, {_SOUND.format(w='term')} AS s FROM ({terms}) "
            "WHERE length(term) > 2 AND term NOT IN (SELECT term FROM irregular))",
            _step(
                "k1a",
                "k0",
                f"WHEN ends_with(w, 'ies') THEN CASE WHEN length(w) = 4 THEN {_stem_of(1)} ELSE {_stem_of(2)} END "
                f"WHEN ends_with(w, 'sses') THEN {_stem_of(2)} WHEN ends_with(w, 'ss') THEN w "
                f"WHEN ends_with(w, 's') THEN {_stem_of(1)}",
            ),
            f"k1p AS (SELECT term, w, s, cut, left(w, length(w) - cut) AS p, left(s, length(s) - cut) AS ps FROM ({past}))",
            _step(
                "k1b",
                "k1p",
                f"WHEN cut > 0 THEN {mended} "
                f"WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN {_stem_of(1)} ELSE {_stem_of(2)} END "
                f"WHEN ends_with(w, 'eed') AND {_measure(3)} > 0 THEN {_stem_of(1)}",
            ),
            _step(
                "k1c",
                "k1b",
                "WHEN ends_with(w, 'y') AND length(w) > 2 AND substr(s, length(s) - 1, 1) = 'c' "
                f"THEN {_stem_of(1)} || 'i'",
            ),
            _step("k2a", "k1c", f"WHEN ends_with(w, 'alli') AND {_measure(4)} > 0 THEN {_stem_of(2)}"),
            _step("k2", "k2a", "WHEN ends_with(w, 'alli') THEN w " + _suffixes(rules_2, 1, ("logi",))),
            _step("k3", "k2", _suffixes(THIRD, 1)),
            _step("k4", "k3", _suffixes({suffix: "" for suffix in FOURTH}, 2)),
            _step(
                "k5a",
                "k4",
                f"WHEN ends_with(w, 'e') AND ({_measure(1)} > 1 OR ({_measure(1)} = 1 "
                f"AND NOT {_short(_stem_of(1), 'left(s, length(s) - 1)')})) THEN {_stem_of(1)}",
            ),
            _step("k5b", "k5a", f"WHEN ends_with(w, 'll') AND {_measure(1)} > 1 THEN {_stem_of(1)}"),
            "stems AS (SELECT term, w AS stem FROM k5b UNION ALL "
            f"SELECT term, coalesce(i.stem, term) FROM ({terms}) LEFT JOIN irregular i USING (term) "
            "WHERE length(term) <= 2 OR i.stem IS NOT NULL)",
        ]
    )


def oracle() -> dict[str, str]:
    all_words = words_cte(stops=False)
    kept_words = words_cte()
    rated_words = words_cte(RATED, label=True)
    kept_cells = cells_cte(kept_words)
    rated_cells = cells_cte(rated_words, label=True)
    rated_total = f"SELECT count(*) FROM {RATED}"
    distinct_terms = "SELECT DISTINCT unnest(w) AS term FROM words"
    stemmed_words = f"{kept_words}, {stems_cte(distinct_terms)}"
    stemmed_cells = (
        f"{stemmed_words}, cells AS (SELECT doc_id, stem AS term, count(*)::INT AS tf FROM "
        "(SELECT doc_id, unnest(w) AS term FROM words) JOIN stems USING (term) GROUP BY ALL)"
    )
    stem_documents = (
        f"WITH {stemmed_words}, placed AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w)))::INT AS pos FROM words) "
        "SELECT doc_id, pos, stem AS term FROM placed JOIN stems USING (term)"
    )
    json_rows = f"SELECT doc_id, text AS \"reviewText\", ({LABEL})::DOUBLE AS overall FROM documents LEFT JOIN labels USING (doc_id)"
    coded = (
        f"WITH coded AS (SELECT ({LABEL})::INT AS label, count(*) AS n FROM labels GROUP BY ALL) "
        "SELECT label, (row_number() OVER (ORDER BY n DESC, label::VARCHAR) - 1)::DOUBLE AS idx FROM coded"
    )
    unindexed = f'SELECT doc_id, ({LABEL})::VARCHAR AS "predictedLabel" FROM labels'
    terms = f"WITH {terms_cte(kept_cells)} SELECT term, df, corpus_count FROM terms"
    tfidf = weights(terms_cte(kept_cells))
    tfidf_stemmed = weights(terms_cte(stemmed_cells))
    tfidf_cut = weights(terms_cte(kept_cells, size=VOCAB_SIZE))
    tfidf_stemmed_cut = weights(terms_cte(stemmed_cells, size=VOCAB_SIZE))
    hashed = "(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100 >= 75)"
    tested = f"SELECT count(*) FILTER ({hashed}) AS n_test, true AS is_hit_share FROM {RATED}"
    hex_number = "(('0x' || substr(md5(doc_id::VARCHAR), {first}, 8))::BIGINT)"
    categories = (
        f"WITH {terms_cte(rated_cells, total=rated_total)}, distinct_tf AS (SELECT term, count(DISTINCT tf) AS n FROM cells GROUP BY term), "
        "valued AS (SELECT term, CASE WHEN df = (SELECT * FROM total) THEN 1 ELSE n + 1 END AS n_values "
        "FROM distinct_tf JOIN terms USING (term)) "
    )
    mapped = (
        f"{categories}, kinds AS (SELECT term, n_values FROM valued WHERE n_values BETWEEN 2 AND 4), seen AS (SELECT DISTINCT term, tf FROM cells) "
        "SELECT term, 0 AS tf, 0 AS code FROM kinds UNION ALL SELECT term, tf, "
        "(row_number() OVER (PARTITION BY term ORDER BY tf))::INT AS code FROM seen JOIN kinds USING (term)"
    )
    in_train = f"NOT {hashed}"
    indexed = (
        f"WITH {rated_cells}, train AS (SELECT * FROM cells WHERE {in_train}), "
        f"total AS (SELECT count(*) AS n FROM {RATED} WHERE {in_train}), "
        "terms AS (SELECT term, count(*) AS df, count(DISTINCT tf) AS n_tf, ln((any_value(n) + 1.0) / (count(*) + 1.0)) AS idf, any_value(n) AS n "
        "FROM train, total GROUP BY term HAVING count(*) >= 5), "
        "codes AS (SELECT term, tf, row_number() OVER (PARTITION BY term ORDER BY tf) AS code FROM (SELECT DISTINCT term, tf FROM train)) "
        "SELECT doc_id, term, round(CASE WHEN df = n THEN 0 WHEN n_tf + 1 > 4 THEN tf * idf ELSE coalesce(code, n_tf + 1) END, 9)::DOUBLE AS value "
        f"FROM (SELECT * FROM cells WHERE {hashed}) JOIN terms USING (term) LEFT JOIN codes USING (term, tf)"
    )
    dependence = (
        f"WITH {rated_cells}, sizes AS (SELECT {LABEL} AS label, count(*) AS n_label FROM {RATED} GROUP BY ALL), "
        "n AS (SELECT sum(n_label)::DOUBLE AS n FROM sizes), o AS (SELECT term, label, count(*) AS o FROM cells GROUP BY ALL), "
        "s AS (SELECT term, sum(o)::BIGINT AS df, sum(o * o / n_label) AS parts FROM o JOIN sizes USING (label) GROUP BY term), "
        "dependence AS (SELECT term, df, round(CASE WHEN df < n THEN n * n / (df * (n - df)) * (parts - df * (df / n)) ELSE 0 END, 9) AS chi_square FROM s, n)"
    )
    stump = (
        f"WITH {words_cte(RATED, label=True)}, {stems_cte(distinct_terms)}, "
        "cells AS (SELECT DISTINCT doc_id, label, stem AS term, count(*) OVER (PARTITION BY stem) AS uses FROM (SELECT doc_id, label, unnest(w) AS term FROM words) "
        "JOIN stems USING (term)), "
        f"rated AS (SELECT doc_id, {LABEL} AS label, {hashed} AS tested FROM {RATED}), "
        "sizes AS (SELECT label, count(*) AS n FROM rated WHERE NOT tested GROUP BY label), "
        "with_term AS (SELECT term, label, count(*) AS o FROM cells JOIN rated USING (doc_id, label) WHERE NOT tested GROUP BY ALL), "
        "frequent AS (SELECT term, sum(o) AS df FROM with_term GROUP BY term HAVING sum(o) >= 10), "
        "uses AS (SELECT stem AS term, count(*) AS uses FROM (SELECT doc_id, unnest(w) AS term FROM words) JOIN stems USING (term) "
        "JOIN rated USING (doc_id) WHERE NOT tested GROUP BY ALL), "
        "sides AS (SELECT term, label, present, CASE WHEN present THEN coalesce(o, 0) ELSE n - coalesce(o, 0) END AS c "
        "FROM frequent CROSS JOIN sizes CROSS JOIN (VALUES (true), (false)) p(present) LEFT JOIN with_term USING (term, label)), "
        "leaves AS (SELECT term, present, sum(c) AS m, 1 - sum(c * c) / (sum(c) * sum(c))::DOUBLE AS gini, max(c) / sum(c) AS share, "
        "arg_min(label, (-c, label)) AS prediction FROM sides WHERE c > 0 GROUP BY ALL), "
        "splits AS (SELECT term, sum(m * gini) AS impurity FROM leaves GROUP BY term HAVING count(*) = 2), "
        "best AS (SELECT term FROM splits JOIN uses USING (term) ORDER BY round(impurity, 9), uses DESC, term LIMIT 1), "
        "ends AS (SELECT doc_id, count(c.term) > 0 AS present FROM rated LEFT JOIN (SELECT doc_id, term FROM cells JOIN best USING (term)) c USING (doc_id) "
        "WHERE tested GROUP BY doc_id) "
        "SELECT doc_id, prediction::DOUBLE AS prediction, round(share, 9) AS share FROM ends JOIN leaves USING (present) JOIN best USING (term)"
    )
    side = {
        "vote": "CASE WHEN doc_id % 3 = 0 THEN 'none' WHEN doc_id % 7 = 1 THEN doc_id || ' votes' ELSE doc_id::VARCHAR END",
        "asin": "CASE WHEN doc_id % 2 = 0 THEN lpad(doc_id::VARCHAR, 10, '0') ELSE 'B' || doc_id END",
        "time": "CASE WHEN doc_id % 13 = 0 THEN 'no date' ELSE lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') || ' ' "
        "|| (doc_id % 28 + 1) || ', ' || (2000 + doc_id % 20) END",
    }
    step_names = (
        "strip_email",
        "strip_breaks",
        "strip_digits",
        "strip_single_letters",
        "collapse_non_word",
        "lower_case",
    )
    result = {
        name: f"SELECT doc_id, {cleaned('text', steps)} AS value FROM documents"
        for steps, name in enumerate(step_names, 1)
    }
    result |= {
        "json_round_trip": json_rows,
        "json_inferred": json_rows,
        "parquet_partition": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
        "parquet_one_partition": "SELECT doc_id, lang, length(text)::INT AS n_chars FROM documents WHERE lang = 'de'",
        "records_to_df": (
            f"WITH r AS (SELECT ({LABEL})::BIGINT AS label, count(*) AS n, bool_or(toxic = 1) AS has_toxic, "
            f"round(avg(n_chars), 9) AS mean_chars, max(lang) AS last_lang FROM {RATED} GROUP BY ALL) SELECT * FROM r"
        ),
        "csv_round_trip": f"SELECT doc_id, ({LABEL})::INT AS label, {cleaned('text')} AS clean FROM documents LEFT JOIN labels USING (doc_id)",
        "label_cast": f"SELECT doc_id, trunc({LABEL})::INT AS label FROM labels",
        "label_truncated": (
            f"SELECT doc_id, trunc(({LABEL} + (doc_id % 10) / 10.0) * CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END)::INT AS label FROM labels"
        ),
        "drop_columns": f'SELECT doc_id, text AS "reviewText" FROM {RATED}',
        "null_fill": f"SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'null' ELSE {cleaned('text')} END AS clean FROM documents",
        "first_100": f"SELECT doc_id, {cleaned('text')} AS clean FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 100)",
        "feature_projection": weights(
            terms_cte(rated_cells, total=rated_total), "doc_id, label::INT AS label, term, round(tf * idf, 9) AS tfidf"
        ),
        "vote_clean": f"SELECT doc_id, try_cast(nullif({side['vote']}, 'none') AS DOUBLE) AS value FROM documents",
        "asin_cast": f"SELECT doc_id, try_cast({side['asin']} AS DOUBLE) AS value FROM documents",
        "style_format": "SELECT doc_id, lang AS value FROM documents",
        "epoch_time": (
            "SELECT doc_id, strftime(make_timestamp((1262304000 + doc_id * 86461) * 1000000), '%Y-%m-%d %H:%M:%S') AS value FROM documents"
        ),
        "review_time": f"SELECT doc_id, try_strptime({side['time']}, '%m %d, %Y') AS value FROM documents",
        "clean_text": f"SELECT doc_id, {cleaned('text')} AS clean FROM documents",
        "tokenise": positions(all_words),
        "tokenise_ml": positions(all_words),
        "remove_stop_words": positions(kept_words),
        "remove_stop_words_ml": positions(kept_words),
        "token_counts": f"WITH {cells_cte(all_words)} SELECT doc_id, term, tf FROM cells",
        "token_counts_no_stop": f"WITH {kept_cells} SELECT doc_id, term, tf FROM cells",
        "stem_tokens": f"WITH {stemmed_words} SELECT term, stem FROM stems",
        "stem_documents": stem_documents,
        "stem_documents_ml": stem_documents,
        "vocabulary": terms,
        "vocabulary_top": f"{terms} ORDER BY corpus_count DESC, term LIMIT 300",
        "vocabulary_shares": (
            f"WITH {terms_cte(kept_cells, 'df >= 0.02 * (SELECT * FROM total) AND df <= 0.5 * (SELECT * FROM total)')} "
            "SELECT term, df, corpus_count FROM terms"
        ),
        "idf_weights": f"WITH {terms_cte(kept_cells)} SELECT term, df, round(idf, 9) AS idf FROM terms",
        "tfidf_long": tfidf,
        "tfidf_ml": tfidf_cut,
        "tfidf_vectors": tfidf_cut,
        "tfidf_stemmed": tfidf_stemmed,
        "tfidf_stemmed_vectors": tfidf_stemmed_cut,
        "forest_accuracy": tested,
        "indexed_accuracy": tested,
        "cross_validation": (
            "SELECT * FROM (VALUES (0::BIGINT, 3::BIGINT, 5::BIGINT, 'gini', true), (1, 5, 5, 'gini', true)) "
            "AS t(point, \"maxDepth\", \"numTrees\", impurity, is_share)"
        ),
        "fitted_stages": tfidf_stemmed_cut,
        "job_round_trip": "SELECT count(DISTINCT p) = 3 AS is_complete, count(*) AS n_parameters FROM (VALUES ('maxDepth'), ('numTrees'), ('impurity')) AS t(p)",
        "best_params": "SELECT true AS is_best, true AS is_complete",
        "hash_split": (
            f"SELECT doc_id, CASE WHEN {hex_number.format(first=1)} % 100 < 75 THEN 'train' ELSE 'test' END AS part FROM documents"
        ),
        "random_split": "SELECT doc_id, 1::BIGINT AS n_parts, true AS share_as_asked FROM documents",
        "fold_assignment": f"SELECT doc_id, ({hex_number.format(first=9)} % 3)::INT AS fold FROM documents",
        "label_index": coded,
        "label_index_ml": coded,
        "label_unindex": unindexed,
        "label_unindex_ml": unindexed,
        "feature_categories": f"{categories} SELECT term, n_values, n_values <= 4 AS is_categorical FROM valued",
        "feature_categories_ml": f"{categories} SELECT term, n_values <= 4 AS is_categorical FROM valued",
        "majority_accuracy": (
            f"WITH coded AS (SELECT {LABEL} AS label, count(*) AS n FROM labels GROUP BY ALL) "
            "SELECT sum(n)::BIGINT AS n, round(max(n) / sum(n), 9) AS accuracy FROM coded"
        ),
        "rule_accuracy": (
            f"WITH hits AS (SELECT ({LABEL} = 3 + n_chars % 2)::INT AS hit FROM {RATED}), "
            "a AS (SELECT count(*) AS n_test, avg(hit) AS accuracy FROM hits) SELECT n_test, round(accuracy, 9) AS accuracy, "
            "round(1 - accuracy, 9) AS test_error, round(accuracy, 9) AS evaluator_accuracy FROM a"
        ),
        "collapse_first_values": (
            "WITH sparse AS (SELECT count(*) AS n, NULL::BIGINT AS m, NULL AS l, NULL::BOOLEAN AS f, NULL::DOUBLE AS c FROM documents "
            "UNION ALL SELECT NULL, max(n_chars), NULL, NULL, NULL FROM documents "
            "UNION ALL SELECT NULL, NULL, max(lang), NULL, NULL FROM documents "
            "UNION ALL SELECT NULL, NULL, NULL, bool_or(lang = 'fr'), NULL FROM documents "
            "UNION ALL SELECT NULL, NULL, NULL, NULL, round(avg(n_chars), 9) FROM documents) "
            "SELECT max(n) AS n_documents, max(m) AS longest, max(l) AS last_lang, bool_or(f) AS has_french, max(c) AS mean_chars FROM sparse"
        ),
        "feature_values": mapped,
        "feature_values_ml": mapped,
        "indexed_features": indexed,
        "term_dependence": f"{dependence} SELECT * FROM dependence",
        "terms_by_dependence": f"{dependence} SELECT * FROM dependence ORDER BY chi_square DESC, term LIMIT 300",
        "tfidf_by_heat": tfidf,
        "json_quarantine": (
            "SELECT doc_id, text AS \"reviewText\", 1.5::DOUBLE AS overall, "
            "(SELECT count(*) FROM documents WHERE doc_id % 7 = 0 OR doc_id % 11 = 0) AS n_bad "
            "FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0"
        ),
        "parquet_pruned_by_join": (
            "WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang) SELECT doc_id, lang, length(text)::INT AS n_chars "
            "FROM documents WHERE lang IN (SELECT lang FROM n WHERE n < (SELECT avg(n) FROM n))"
        ),
        "csv_published": "SELECT lang, count(*) AS n, max(n_chars) AS longest FROM documents GROUP BY lang",
        "forest_stump": stump,
        "learnt_rule": (
            'SELECT 2::BIGINT AS "maxDepth", 1::BIGINT AS "numTrees", \'all\' AS "featureSubsetStrategy", '
            f"count(*) FILTER ({hashed}) AS n_test, 1.0::DOUBLE AS accuracy, true AS two_terms FROM documents"
        ),
        "out_of_fold_scores": (
            f"SELECT p::INT AS point, ({hex_number.format(first=9)} % 2)::INT AS fold, count(*) AS n_rows, true AS is_score, true AS is_mean "
            f"FROM {RATED}, range(2) t(p) WHERE NOT {hashed} GROUP BY ALL"
        ),
    }
    return result
