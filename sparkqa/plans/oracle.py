"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Views ``documents``, ``benchmark``, ``customer`` ... are registered by the checker.  Shared
CTEs (fixtures, BM25 index, results) are kept once in ``CTES`` and pulled in with their
dependencies by ``sql(...)``, so every oracle query is one self-contained statement.
"""

from __future__ import annotations

from sparkqa.functions.stopwords import ENGLISH_STOP_WORDS

LINE = 100  # candidates of a search or gold line (Fx-table-search files)
TOPK = 20  # k used by the ranked-result fixture (Fx-results)

UNI_TOKENS = r"[\p{L}\p{N}\p{M}]+|[^\p{Z}\p{C}]"

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, body: str, deps: list[str] | None = None) -> None:
    CTES[name] = (body, deps or [])


def sql(final: str, deps: list[str]) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    parts = [f"{n} AS ({CTES[n][0]})" for n in order]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


def alnum(expr: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({expr}, ''), '[A-Za-z0-9]+'), lambda x: lower(x))"


def uni_key(expr: str) -> str:
    """Framed, lower-cased Unicode tokens of ``expr`` (no NFD: exact on ASCII answers)."""
    return (f"(' ' || array_to_string(list_transform(regexp_extract_all(coalesce({expr}, ''), "
            f"'{UNI_TOKENS}'), lambda x: lower(x)), ' ') || ' ')")


def nfd_sql(expr: str) -> str:
    """Unicode NFD for the Latin letters (U+00C0-U+024F), generated from the Unicode database:
    one ``replace`` per precomposed letter.  DuckDB has no NFD function."""
    import unicodedata
    out = expr
    for cp in range(0xC0, 0x250):
        c = chr(cp)
        d = unicodedata.normalize("NFD", c)
        if d != c:
            out = f"replace({out}, '{c}', '{d}')"
    return out


# --- fixtures --------------------------------------------------------------------------------------
cte("corpus", "SELECT CAST(doc_id AS VARCHAR) AS id, text, source AS title, CAST(doc_id AS BIGINT) AS row_no "
              "FROM documents")
cte("bq", f"SELECT CAST(item_id AS BIGINT) AS qid, {alnum('text')} AS tk FROM benchmark")
cte("questions", "SELECT qid, array_to_string(tk, ' ') AS question, "
                 "list_filter([CASE WHEN len(tk) >= 7 THEN array_to_string(tk[7:8], ' ') END, tk[10]], "
                 "lambda a: a IS NOT NULL) AS answers FROM bq", ["bq"])

# --- BM25 (A1-A4, X1) ------------------------------------------------------------------------------
cte("dtok", f"SELECT row_no, id, {alnum('text')} AS tk FROM corpus", ["corpus"])
cte("post", "SELECT row_no, id, dl, term, count(*) AS tf FROM "
            "(SELECT row_no, id, len(tk) AS dl, unnest(tk) AS term FROM dtok WHERE len(tk) > 0) "
            "GROUP BY row_no, id, dl, term", ["dtok"])
cte("bstats", "SELECT count(*) AS n_docs, CASE WHEN count(*) > 0 THEN sum(dl) / count(*) ELSE 0.0 END AS avgdl "
              "FROM (SELECT DISTINCT row_no, dl FROM post)", ["post"])
cte("dfs", "SELECT term, count(*) AS df FROM post GROUP BY term", ["post"])
cte("bvocab", "SELECT term, df, ln(1 + (n_docs - df + 0.5) / (df + 0.5)) AS idf FROM dfs, bstats "
              "WHERE df >= 2 AND df <= greatest(CAST(floor(0.3 * n_docs) AS BIGINT), 1)", ["dfs", "bstats"])
cte("qterms", "SELECT qid, term, count(*) AS qtf, min(pos) AS min_pos FROM "
              f"(SELECT qid, unnest(tk) AS term, unnest(range(len(tk))) AS pos FROM "
              f"(SELECT qid, {alnum('question')} AS tk FROM questions)) GROUP BY qid, term", ["questions"])
cte("bscored", "SELECT qid, p.row_no, p.id, "
               "sum(qtf * idf * (tf * (1.2 + 1.0)) / (tf + 1.2 * (1.0 - 0.75 + 0.75 * (dl / "
               "CASE WHEN avgdl > 0 THEN avgdl ELSE 1.0 END)))) AS score, min(min_pos) AS first_pos "
               "FROM qterms JOIN bvocab USING (term) JOIN post p USING (term), bstats "
               "GROUP BY qid, p.row_no, p.id", ["qterms", "bvocab", "post", "bstats"])
cte("results", "SELECT qid, CAST(rank AS BIGINT) AS rank, id AS doc_id, score FROM "
               "(SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, first_pos, row_no) "
               f"AS rank FROM bscored) WHERE rank <= {TOPK}", ["bscored"])

# --- matching (E1, E5) -----------------------------------------------------------------------------
cte("ptext", "SELECT id, arg_max(text, row_no) AS text, arg_max(title, row_no) AS title FROM corpus GROUP BY id",
    ["corpus"])
cte("akeys", "SELECT qid, list_transform(answers, lambda a: {'n': len(regexp_extract_all(a, '"
             + UNI_TOKENS + "')), 'key': " + uni_key("a") + "}) AS ak FROM questions", ["questions"])


def hits_and_recall(suffix: str, results: str, max_k: int = TOPK) -> None:
    cte("hits" + suffix,
        "SELECT r.qid, r.rank, r.doc_id, coalesce(CASE WHEN p.text IS NULL THEN false ELSE "
        "len(list_filter(k.ak, lambda a: a.n = 0 OR instr(" + uni_key("p.text") + ", a.key) > 0)) > 0 END, false) "
        f"AS has_answer FROM {results} r LEFT JOIN ptext p ON p.id = r.doc_id LEFT JOIN akeys k ON k.qid = r.qid",
        [results, "ptext", "akeys"])
    cte("recall" + suffix,
        "SELECT g.k, CAST(count(f.first_hit) AS BIGINT) AS hits, "
        "count(f.first_hit) / (SELECT count(*) FROM questions) AS recall FROM "
        f"(SELECT CAST(range AS BIGINT) AS k FROM range(1, {max_k} + 1)) g LEFT JOIN "
        "(SELECT q.qid, min(CASE WHEN h.has_answer THEN h.rank END) AS first_hit FROM questions q "
        f"LEFT JOIN hits{suffix} h USING (qid) GROUP BY q.qid) f ON f.first_hit <= g.k GROUP BY g.k",
        ["hits" + suffix, "questions"])


hits_and_recall("", "results")

# --- TF-IDF (N6, N9, A5, X3) -----------------------------------------------------------------------
STOP_LIST = "[" + ", ".join("'" + w + "'" for w in sorted(ENGLISH_STOP_WORDS)) + "]"
MAX_FEATURES = 200_000
Q = "'"  # a single quote, for SQL literals built in Python


def words(expr: str) -> str:
    return (f"list_filter(regexp_extract_all(lower(coalesce({expr}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'), "
            f"lambda x: NOT list_contains({STOP_LIST}, x))")


def grams(tk: str) -> str:
    return f"{tk} || list_transform(range(1, len({tk})), lambda i: {tk}[i] || ' ' || {tk}[i + 1])"


cte("twords", "SELECT row_no, " + words("trim(coalesce(title, '') || ' ' || coalesce(text, ''))")
    + " AS tk FROM corpus", ["corpus"])
cte("ttf", f"SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest({grams('tk')}) AS term FROM twords) "
           "GROUP BY row_no, term", ["twords"])
cte("tvocab", "SELECT term, df, ctf, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM "
              "(SELECT term, count(*) AS df, sum(tf) AS ctf, row_number() OVER (ORDER BY sum(tf) DESC, term ASC) AS vr "
              f"FROM ttf GROUP BY term), (SELECT count(*) AS n FROM corpus) WHERE vr <= {MAX_FEATURES}",
    ["ttf", "corpus"])
cte("tweights", "SELECT term, row_no, CAST(raw / norm AS FLOAT) AS w FROM "
                "(SELECT term, row_no, tf * idf AS raw, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY row_no)) AS norm "
                "FROM ttf JOIN tvocab USING (term))", ["ttf", "tvocab"])
cte("tqv", "SELECT qid, term, CAST(raw / norm AS FLOAT) AS wq FROM "
           "(SELECT qid, term, tf * idf AS raw, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY qid)) AS norm FROM "
           f"(SELECT qid, term, count(*) AS tf FROM (SELECT qid, unnest({grams('tk')}) AS term FROM "
           f"(SELECT qid, {words('question')} AS tk FROM questions)) GROUP BY qid, term) JOIN tvocab USING (term))",
    ["questions", "tvocab"])
cte("tranked", "SELECT * FROM (SELECT qid, row_no, id AS doc_id, score, row_number() OVER "
               "(PARTITION BY qid ORDER BY round(score, 9) DESC, row_no) AS rank FROM "
               "(SELECT qid, w.row_no, c.id, sum(CAST(wq AS DOUBLE) * CAST(w AS DOUBLE)) AS score "
               "FROM tqv JOIN tweights w USING (term) JOIN corpus c ON c.row_no = w.row_no GROUP BY qid, w.row_no, c.id)) "
               f"WHERE rank <= {TOPK}", ["tqv", "tweights", "corpus"])
cte("tresults", "SELECT qid, CAST(rank AS BIGINT) AS rank, doc_id, score FROM tranked UNION ALL "
                "SELECT qid, CAST(rank AS BIGINT), doc_id, score FROM ("
                "SELECT m.qid, m.m + row_number() OVER (PARTITION BY m.qid ORDER BY f.row_no) AS rank, f.id AS doc_id, "
                "0.0 AS score FROM (SELECT q.qid, count(r.qid) AS m FROM questions q LEFT JOIN tranked r USING (qid) "
                f"GROUP BY q.qid) m, (SELECT row_no, id FROM corpus ORDER BY row_no LIMIT {TOPK}) f "
                f"WHERE m.m < {TOPK} AND NOT EXISTS (SELECT 1 FROM tranked r WHERE r.qid = m.qid AND r.row_no = f.row_no)) "
                f"WHERE rank <= {TOPK}", ["tranked", "questions", "corpus"])
hits_and_recall("_t", "tresults")

# --- X2: Fx-bad-ids ---------------------------------------------------------------------------------
cte("badcorpus", "SELECT 'd' || id AS id, row_no FROM corpus", ["corpus"])
cte("badresults", "SELECT qid, rank, CASE rank % 4 WHEN 1 THEN 'd' || doc_id WHEN 2 THEN doc_id "
                  "WHEN 3 THEN 'x' || doc_id ELSE CAST(CAST(doc_id AS BIGINT) + 1000000 AS VARCHAR) END AS doc_id, "
                  "score FROM results", ["results"])
cte("fixedids", "SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY rank) AS BIGINT) AS rank, "
                "coalesce(k.id, p.id) AS doc_id, score FROM badresults r "
                "LEFT JOIN (SELECT DISTINCT id FROM badcorpus) k ON k.id = r.doc_id "
                "LEFT JOIN badcorpus p ON k.id IS NULL AND p.row_no = TRY_CAST(r.doc_id AS BIGINT) "
                "WHERE coalesce(k.id, p.id) IS NOT NULL", ["badresults", "badcorpus"])

# --- E2 / E3 / E4 ----------------------------------------------------------------------------------
cte("rhits", "SELECT r.qid, r.rank, r.doc_id, coalesce(regexp_matches(" + nfd_sql("p.text") + ", '(?i)t[a-z]{2}e'), false) AS has_answer "
             "FROM results r LEFT JOIN ptext p ON p.id = r.doc_id", ["results", "ptext"])
WS = r"[\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}]"


def n4(expr: str) -> str:
    """Answer normalisation with Unicode word boundaries emulated (RE2 has only ASCII \\b)."""
    x = f"regexp_replace(lower({expr}), '[!-/:-@\\[-`{{-~]', '', 'g')"
    art = "'(^|[^\\pL\\pN\\pM_])(a|an|the)([^\\pL\\pN\\pM_]|$)'"
    x = f"regexp_replace(regexp_replace({x}, {art}, '\\1 \\3', 'g'), {art}, '\\1 \\3', 'g')"
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


cte("khits", f"SELECT r.qid, r.rank, r.doc_id, coalesce(len(list_filter(q.answers, lambda a: "
             f"instr({n4('p.text')}, {n4('a')}) > 0)) > 0, false) AS has_answer FROM results r "
             "LEFT JOIN ptext p ON p.id = r.doc_id LEFT JOIN questions q ON q.qid = r.qid",
    ["results", "ptext", "questions"])
cte("mhits", "SELECT r.qid, r.rank, r.doc_id, coalesce(len(list_filter(k.ak, lambda a: a.n = 0 OR instr("
             + uni_key("coalesce(p.title, '') || ' . ' || coalesce(p.text, '')")
             + ", a.key) > 0)) > 0, false) AS has_answer FROM results r LEFT JOIN ptext p ON p.id = r.doc_id "
             "LEFT JOIN akeys k ON k.qid = r.qid", ["results", "ptext", "akeys"])

GOLD_SUFFIX = f"{Q}The {Q} || text || {Q} !{Q}"

ORACLE: dict[str, str] = {
    "a1_term_frequencies": sql("SELECT row_no, term, CAST(tf AS BIGINT) AS tf FROM post", ["post"]),
    "a2_corpus_stats": sql("SELECT CAST(n_docs AS BIGINT) AS n_docs, round(avgdl, 6) AS avgdl FROM bstats", ["bstats"]),
    "a3_document_frequency": sql("SELECT term, CAST(df AS BIGINT) AS df FROM bvocab", ["bvocab"]),
    "a4_bm25_index": sql("SELECT p.term, p.row_no, CAST(p.tf AS BIGINT) AS tf, CAST(v.df AS BIGINT) AS df, "
                         "round(v.idf, 6) AS idf FROM post p JOIN bvocab v USING (term)", ["post", "bvocab"]),
    "x1_bm25_topk": sql("SELECT qid, rank, doc_id, round(score, 6) AS score FROM results", ["results"]),
    "e1_match_string": sql("SELECT qid, rank, doc_id, has_answer FROM hits", ["hits"]),
    "e5_hit_at_k": sql("SELECT k, hits, round(recall, 6) AS recall FROM recall", ["recall"]),
    "n6_tokenize_words": sql("SELECT row_no, array_to_string(tk, ' ') AS tokens FROM twords", ["twords"]),
    "a5_tfidf_vocab": sql("SELECT term, CAST(df AS BIGINT) AS df, CAST(ctf AS BIGINT) AS ctf, round(idf, 6) AS idf "
                          "FROM tvocab", ["tvocab"]),
    "a5_tfidf_weights": sql("SELECT term, row_no, round(CAST(w AS DOUBLE), 5) AS w FROM tweights", ["tweights"]),
    "x3_tfidf_topk": sql("SELECT qid, rank, doc_id, round(score, 5) AS score FROM tresults", ["tresults"]),
    "e6_validate_tfidf": sql("SELECT k, hits, round(recall, 6) AS recall FROM recall_t", ["recall_t"]),
    "e8_compare_models": sql("SELECT b.k, round(b.recall, 6) AS bm25, round(t.recall, 6) AS tfidf FROM recall b "
                             "JOIN recall_t t USING (k) WHERE b.k IN (1, 5, 10, 20)", ["recall", "recall_t"]),
    "x2_normalize_doc_ids": sql("SELECT qid, rank, doc_id, round(score, 6) AS score FROM fixedids", ["fixedids"]),
    "x4_passage_lookup": sql("SELECT r.qid, r.rank, r.doc_id, p.title, CAST(length(p.text) AS BIGINT) AS text_len, "
                             "p.id IS NOT NULL AS found FROM results r LEFT JOIN ptext p ON p.id = r.doc_id",
                             ["results", "ptext"]),
    "e2_match_regex": sql("SELECT qid, rank, doc_id, has_answer FROM rhits", ["rhits"]),
    "e3_match_kilt": sql("SELECT qid, rank, doc_id, has_answer FROM khits", ["khits"]),
    "e4_match_from_meta": sql("SELECT qid, rank, doc_id, has_answer FROM mhits", ["mhits"]),
    "n1_normalize_question": sql("SELECT qid, CASE WHEN suffix(q, '?') THEN q ELSE q || '?' END AS question FROM "
                                 f"(SELECT qid, replace(question, '’', {Q}{Q}{Q}{Q}) AS q FROM questions)",
                                 ["questions"]),
    "n2_normalize_passage": sql("SELECT row_no, regexp_replace(regexp_replace(replace(replace(text, chr(10), ' '), "
                                f"'’', {Q}{Q}{Q}{Q}), '^\"', ''), '\"$', '') AS text FROM corpus", ["corpus"]),
    "n4_normalize_answer": sql(f"SELECT conv_id, turn, {n4('text')} AS norm FROM conversations", []),
    "n14_exact_match": sql(f"SELECT conv_id, turn, {n4('text')} = {n4(GOLD_SUFFIX)} AS em FROM conversations", []),
    "n5_tokenize_alnum": sql("SELECT row_no, array_to_string(tk, ' ') AS tokens, CAST(len(tk) AS BIGINT) AS n "
                             "FROM dtok", ["dtok"]),
    "n7_tokenize_unicode": sql("SELECT row_no, array_to_string(list_transform(regexp_extract_all(coalesce(text, ''), '"
                               + UNI_TOKENS + "'), lambda x: lower(x)), ' ') AS tokens FROM corpus", ["corpus"]),
    "n9_token_ngrams": sql("SELECT row_no, CAST(s AS BIGINT) AS start, CAST(n AS BIGINT) AS n, gram FROM ("
                           "SELECT row_no, unnest(range(len(tk))) AS s, 1 AS n, unnest(tk) AS gram FROM dtok "
                           "UNION ALL SELECT row_no, unnest(range(len(tk) - 1)) AS s, 2 AS n, "
                           "unnest(list_transform(range(1, len(tk)), lambda i: tk[i] || ' ' || tk[i + 1])) AS gram "
                           "FROM dtok WHERE len(tk) > 1)", ["dtok"]),
}

# --- tables (Fx-pages / Fx-dirty, T1-T7, T13, A6, K5) ------------------------------------------------
NL = "chr(10)"
cte("fpages", "SELECT CAST(c_custkey * 2 AS BIGINT) AS page_id, c_custkey, c_name AS title, c_acctbal < 0 AS issues "
              "FROM customer UNION ALL SELECT CAST(c_custkey * 2 + 1 AS BIGINT), c_custkey, c_name, c_acctbal < 0 "
              "FROM customer WHERE c_mktsegment = 'BUILDING'")
cte("forders", "SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, "
               "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders")
# one row per (page, row): row 0 is the header
cte("frows", "SELECT p.page_id, 0 AS row, ['order', 'status', 'priority'] AS vals FROM fpages p UNION ALL "
             "SELECT p.page_id, o.r AS row, [CAST(o.o_orderkey AS VARCHAR), o.o_orderstatus, "
             "array_to_string(string_split(o.o_orderpriority, ' '), ' ')] FROM fpages p "
             "JOIN forders o ON o.o_custkey = p.c_custkey", ["fpages", "forders"])
cte("ftables", "SELECT p.page_id, p.title AS caption, p.issues, count(*) AS n_rows, "
               f"'<T>: ' || p.title || {NL} || ' rows:' || {NL} || string_agg(' row #' || r.row || ': ' || "
               f"array_to_string(r.vals, '| ') || {NL}, '' ORDER BY r.row) AS key, "
               "string_agg(array_to_string(r.vals, ' . '), '' ORDER BY r.row) || ' . ' AS table_text "
               "FROM fpages p JOIN frows r USING (page_id) GROUP BY p.page_id, p.title, p.issues",
    ["fpages", "frows"])
cte("fclean", "SELECT CAST(row_number() OVER (ORDER BY page_id) AS BIGINT) AS table_id, * FROM "
              "(SELECT arg_min(page_id, page_id) AS page_id, arg_min(caption, page_id) AS caption, key, "
              "arg_min(table_text, page_id) AS table_text FROM ftables WHERE NOT issues AND n_rows > 1 GROUP BY key)",
    ["ftables"])
cte("fclean_rows", "SELECT c.table_id, c.caption, r.row, r.vals FROM fclean c JOIN frows r USING (page_id)",
    ["fclean", "frows"])
cte("flin", "SELECT table_id, caption, row, array_to_string(vals, ', ') AS lin, "
            "list_sum(list_transform(vals, lambda v: len(string_split(v, ' ')))) AS n FROM fclean_rows",
    ["fclean_rows"])


def chunk_oracle(name: str, max_len: int) -> None:
    """T7 as a recursive walk over each table's rows (the fold the Spark side does per table)."""
    cte(name + "_h", "SELECT table_id, caption, min(row) AS h FROM flin WHERE length(lin) > 1 GROUP BY ALL", ["flin"])
    cte(name + "_w",
        "SELECT * FROM (WITH RECURSIVE walk(table_id, i, cur, n, chunks, emitted) AS ("
        "SELECT h.table_id, h.h + 1, [l.lin], l.n, []::VARCHAR[], NULL::VARCHAR FROM "
        f"{name}_h h JOIN flin l ON l.table_id = h.table_id AND l.row = h.h "
        "UNION ALL SELECT w.table_id, w.i + 1, "
        f"CASE WHEN s.n2 >= {max_len} THEN [hd.lin] ELSE s.cur2 END, "
        f"CASE WHEN s.n2 >= {max_len} THEN hd.n ELSE s.n2 END, w.chunks, "
        f"CASE WHEN s.n2 >= {max_len} THEN array_to_string(s.cur2, {NL}) || {NL} END "
        "FROM walk w JOIN flin r ON r.table_id = w.table_id AND r.row = w.i "
        f"JOIN {name}_h h ON h.table_id = w.table_id JOIN flin hd ON hd.table_id = w.table_id AND hd.row = h.h, "
        "LATERAL (SELECT CASE WHEN length(r.lin) > 1 THEN list_append(w.cur, r.lin) ELSE w.cur END AS cur2, "
        "w.n + CASE WHEN length(r.lin) > 1 THEN r.n ELSE 0 END AS n2) s"
        ") SELECT * FROM walk)", [name + "_h", "flin"])
    cte(name, "SELECT CAST(row_number() OVER (ORDER BY table_id, ord) - 1 AS BIGINT) AS id, text, caption AS title, "
              "CAST(table_id - 1 AS BIGINT) AS table_no FROM ("
              f"SELECT w.table_id, w.i AS ord, w.emitted AS text, h.caption FROM {name}_w w JOIN {name}_h h USING (table_id) "
              "WHERE w.emitted IS NOT NULL UNION ALL "
              f"SELECT w.table_id, 1e9 AS ord, array_to_string(w.cur, {NL}) || {NL}, h.caption FROM {name}_w w "
              f"JOIN {name}_h h USING (table_id) WHERE len(w.cur) > 1 AND w.i = "
              f"(SELECT max(i) FROM {name}_w x WHERE x.table_id = w.table_id))", [name + "_w", name + "_h"])


chunk_oracle("fchunks", 100)
chunk_oracle("fchunks5", 5)

ORACLE.update({
    "t1_extract_tables": sql(
        "SELECT page_id, CAST(CASE WHEN issues THEN -1 ELSE 0 END AS BIGINT) AS table_no, CAST(-1 AS BIGINT) AS parent_no, "
        "CASE WHEN issues THEN NULL ELSE caption END AS caption, "
        "CAST(CASE WHEN issues THEN NULL ELSE n_rows END AS BIGINT) AS n_rows, "
        "CASE WHEN issues THEN NULL ELSE key END AS key, "
        "CASE WHEN issues THEN 'content before any table' END AS error FROM ftables", ["ftables"]),
    "t3_table_key": sql("SELECT page_id, CAST(0 AS BIGINT) AS table_no, key FROM ftables WHERE NOT issues", ["ftables"]),
    "t5_table_text": sql("SELECT page_id, CAST(0 AS BIGINT) AS table_no, table_text AS text FROM ftables WHERE NOT issues", ["ftables"]),
    "t2_clean_tables": sql("SELECT table_id, page_id, caption, key FROM fclean", ["fclean"]),
    "a6_table_stats": sql(
        "SELECT CAST(count(*) FILTER (WHERE issues) AS BIGINT) AS pages_with_issues, "
        "CAST(count(*) FILTER (WHERE NOT issues AND n_rows <= 1) AS BIGINT) AS single_row_tables, "
        "CAST(0 AS BIGINT) AS nested_tables, "
        "CAST(count(*) FILTER (WHERE NOT issues AND n_rows > 1) AS BIGINT) AS regular_tables, "
        "CAST(count(*) FILTER (WHERE NOT issues) AS BIGINT) AS total_tables, "
        "CAST(coalesce(sum(n_rows) FILTER (WHERE NOT issues AND n_rows > 1), 0) AS BIGINT) AS total_rows FROM ftables",
        ["ftables"]),
    "t4_to_nested_json": sql("SELECT table_id, caption, CAST(row AS BIGINT) AS row, CAST(c - 1 AS BIGINT) AS col, "
                             "vals[c] AS value FROM (SELECT *, unnest(range(1, len(vals) + 1)) AS c FROM fclean_rows)",
                             ["fclean_rows"]),
    "k5_table_passages": sql("SELECT table_id AS id, table_text, caption FROM fclean", ["fclean"]),
    "t6_linearize_row": sql("SELECT table_id, CAST(row AS BIGINT) AS row, lin, CAST(n AS BIGINT) AS n_words FROM flin",
                            ["flin"]),
    "t7_chunk_tables": sql("SELECT id, text, title, table_no FROM fchunks", ["fchunks"]),
    "t7_chunk_tables_small": sql("SELECT id, text, title, table_no FROM fchunks5", ["fchunks5"]),
    "t13_long_answer_training": sql(
        "SELECT page_id, caption, CAST(count(*) AS BIGINT) AS n_rows, "
        f"string_agg(array_to_string(vals, '|'), {NL} ORDER BY row) AS rows_text FROM "
        "(SELECT p.page_id, p.title AS caption, r.row, r.vals FROM fpages p JOIN frows r USING (page_id) "
        "WHERE NOT p.issues) GROUP BY page_id, caption", ["fpages", "frows"]),
})

# --- table search, mining, gold, assembly, linearisation (T8-T12, E7) ----------------------------------
cte("ftq", "SELECT CAST(n_nationkey * 2 AS BIGINT) AS q, n_nationkey, 'orders in ' || n_name AS question, "
           "['1-URGENT'] AS answers, '1-urgent' AS ans FROM nation UNION ALL "
           "SELECT CAST(n_nationkey * 2 + 1 AS BIGINT), n_nationkey, 'orders in ' || n_name || ' none', "
           "['9-NONE'], '9-none' FROM nation")
cte("fnt", "SELECT c.table_id, c.page_id, c.caption, cu.c_custkey, cu.c_nationkey AS n_nationkey FROM fclean c "
           "JOIN customer cu ON c.page_id = cu.c_custkey * 2", ["fclean"])


def search_oracle(name: str, desc: bool) -> None:
    order = "DESC" if desc else ""
    cte(name, "SELECT q.q, q.ans, t.table_id, t.page_id, t.caption, CAST(row_number() OVER "
              f"(PARTITION BY q.q ORDER BY t.c_custkey {order}) AS BIGINT) AS rank FROM ftq q JOIN fnt t USING (n_nationkey)", ["ftq", "fnt"])
    cte(name + "_loc", "SELECT s.q, s.table_id, s.page_id, s.caption, s.rank, "
                       "string_agg(r.row || ':2', ',' ORDER BY r.row) AS answer_pos, list(r.row ORDER BY r.row) "
                       "FILTER (WHERE r.row IS NOT NULL) AS arows FROM " + name + " s LEFT JOIN frows r "
                       "ON r.page_id = s.page_id AND r.row > 0 AND list_contains(string_split(lower(r.vals[3]), ' '), s.ans) "
                       "GROUP BY s.q, s.table_id, s.page_id, s.caption, s.rank", [name, "frows"])


search_oracle("fsearch", False)
search_oracle("fgold", True)
cte("fmined", "SELECT * FROM (SELECT *, answer_pos IS NOT NULL AS is_positive, "
              "coalesce(sum(CASE WHEN answer_pos IS NOT NULL THEN 1 ELSE 0 END) OVER w, 0) AS p, "
              "coalesce(sum(CASE WHEN answer_pos IS NULL THEN 1 ELSE 0 END) OVER w, 0) AS n FROM fsearch_loc "
              "WINDOW w AS (PARTITION BY q ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) "
              "WHERE NOT ((p >= 10 AND n >= 10) OR n >= 30)", ["fsearch_loc"])
cte("finj", "SELECT q, rank, table_id, page_id, caption, answer_pos, arows, is_positive, false AS gold_match FROM fmined "
            "UNION ALL SELECT q, CAST(-1 AS BIGINT), table_id, page_id, caption, answer_pos, arows, true, true FROM "
            "(SELECT *, row_number() OVER (PARTITION BY q ORDER BY rank) AS rr FROM fgold_loc WHERE answer_pos IS NOT NULL) "
            "WHERE rr = 1", ["fmined", "fgold_loc"])
cte("fgoldpage", "SELECT t.q, p.page_id, p.title AS caption, "
                 "string_agg(r.row || ':2', ',' ORDER BY r.row) AS answer_pos, list(r.row ORDER BY r.row) AS arows "
                 "FROM ftq t JOIN (SELECT c_nationkey, min(c_custkey) AS k FROM customer GROUP BY c_nationkey) g "
                 "ON g.c_nationkey = t.n_nationkey JOIN fpages p ON p.page_id = g.k * 2 AND NOT p.issues "
                 "JOIN frows r ON r.page_id = p.page_id AND r.row > 0 AND "
                 "list_contains(string_split(lower(r.vals[3]), ' '), t.ans) GROUP BY t.q, p.page_id, p.title",
    ["ftq", "fpages", "frows"])
cte("fctx", "SELECT q, 'positive' AS kind, o, page_id, caption, gm, answer_pos, arows FROM ("
            "SELECT q, CAST(rank AS DOUBLE) AS o, page_id, caption, CASE WHEN gold_match THEN 1 ELSE 0 END AS gm, "
            "answer_pos, arows FROM finj WHERE is_positive UNION ALL "
            "SELECT q, 1e9, page_id, caption, 0, answer_pos, arows FROM fgoldpage) UNION ALL "
            "SELECT q, 'hard_negative', rank, page_id, caption, 0, answer_pos, arows FROM finj WHERE NOT is_positive",
    ["finj", "fgoldpage"])


def linearize_oracle(name: str, max_len: int) -> None:
    cte(name, "SELECT q, string_agg(lin, chr(10) ORDER BY phase, ord) || chr(10) AS text FROM ("
              "SELECT *, coalesce(sum(n) OVER (PARTITION BY q ORDER BY phase, ord ROWS BETWEEN UNBOUNDED PRECEDING "
              "AND 1 PRECEDING), 0) AS prior FROM ("
              "SELECT f.q, r.row, array_to_string(r.vals, ', ') AS lin, "
              "list_sum(list_transform(r.vals, lambda v: len(string_split(v, ' ')))) AS n, "
              "CASE WHEN r.row = 0 THEN 0 WHEN list_contains(f.arows, r.row) THEN 1 ELSE 2 END AS phase, "
              "CASE WHEN list_contains(f.arows, r.row) THEN list_position(f.arows, r.row) ELSE r.row END AS ord, "
              "r.row = f.arows[1] AS first_ap FROM "
              "(SELECT * FROM fctx WHERE kind = 'positive' QUALIFY row_number() OVER (PARTITION BY q ORDER BY o) = 1) f "
              "JOIN frows r ON r.page_id = f.page_id)) "
              f"WHERE phase = 0 OR (phase = 1 AND (first_ap OR prior < {max_len})) OR (phase = 2 AND prior < {max_len}) "
              "GROUP BY q", ["fctx", "frows"])


linearize_oracle("flin5", 5)
linearize_oracle("flin100", 100)

cte("fe7res", "SELECT q.q AS qid, q.ans, c.id, c.table_no, c.text, "
              "CAST(row_number() OVER (PARTITION BY q.q ORDER BY t.c_custkey, c.id) AS BIGINT) AS rank "
              "FROM fchunks5 c JOIN fnt t ON t.table_id = c.table_no + 1 JOIN ftq q USING (n_nationkey)", ["fchunks5", "fnt", "ftq"])
cte("fe7hit", "SELECT r.qid, r.rank, instr(" + uni_key("r.text") + ", " + uni_key("r.ans") + ") > 0 AS chunk_hit, "
              "EXISTS (SELECT 1 FROM fchunks5 c2 WHERE c2.table_no = r.table_no AND instr("
              + uni_key("c2.text") + ", " + uni_key("r.ans") + ") > 0) AS table_hit FROM fe7res r",
    ["fe7res", "fchunks5"])
cte("fe7", "SELECT g.k, CAST(count(f.ch) FILTER (WHERE f.ch <= g.k) AS BIGINT) AS chunk_hits, "
           "CAST(count(f.th) FILTER (WHERE f.th <= g.k) AS BIGINT) AS table_hits, "
           "(SELECT count(*) FROM ftq) AS nq FROM "
           f"(SELECT CAST(range AS BIGINT) AS k FROM range(1, {TOPK} + 1)) g, "
           "(SELECT q.q, min(CASE WHEN h.chunk_hit THEN h.rank END) AS ch, min(CASE WHEN h.table_hit THEN h.rank END) AS th "
           "FROM ftq q LEFT JOIN fe7hit h ON h.qid = q.q GROUP BY q.q) f GROUP BY g.k", ["fe7hit", "ftq"])

ORACLE.update({
    "t9_locate_answers": sql("SELECT q, table_id, answer_pos FROM fsearch_loc", ["fsearch_loc"]),
    "t10_mine_contexts": sql("SELECT q, rank, table_id, is_positive FROM fmined", ["fmined"]),
    "t11_inject_gold": sql("SELECT q, rank, table_id, is_positive, gold_match FROM finj", ["finj"]),
    "t12_assemble_table_training": sql(
        "SELECT q, kind, CAST(row_number() OVER (PARTITION BY q, kind ORDER BY o) - 1 AS BIGINT) AS ord, caption, "
        "CAST(gm AS BIGINT) AS gold_match, answer_pos FROM fctx", ["fctx"]),
    "t8_linearize_table": sql("SELECT q, text FROM flin5", ["flin5"]),
    "t8_linearize_table_long": sql("SELECT q, text FROM flin100", ["flin100"]),
    "e7_match_table_chunks": sql("SELECT k, chunk_hits, round(chunk_hits / nq, 6) AS chunk_recall, table_hits, "
                                 "round(table_hits / nq, 6) AS table_recall FROM fe7", ["fe7"]),
})

# --- sources and sinks (S1-S13, K1-K8): the file round trip must be the identity ----------------------
JOIN_ANS = "array_to_string(answers, '|')"


def n1(expr: str, suffix: str = "") -> str:
    x = f"replace({expr}, '’', {Q}{Q}{Q}{Q})"
    return f"CASE WHEN suffix({x}, '{suffix}') THEN {x} ELSE {x} || '{suffix}' END" if suffix else x


def n2(expr: str) -> str:
    return (f"regexp_replace(regexp_replace(replace(replace({expr}, chr(10), ' '), '’', {Q}{Q}{Q}{Q}), "
            "'^\"', ''), '\"$', '')")


cte("thits", "SELECT h.qid, h.rank, h.doc_id, h.has_answer, p.text, p.title FROM hits h "
             "LEFT JOIN ptext p ON p.id = h.doc_id", ["hits", "ptext"])
cte("tsamples", "SELECT q.qid, q.question || '’' AS question, "
                "coalesce(count(*) FILTER (WHERE t.has_answer), 0) AS n_pos, "
                "coalesce(count(*) FILTER (WHERE NOT t.has_answer), 0) AS n_hard, "
                "coalesce(string_agg(t.doc_id, '|' ORDER BY t.rank) FILTER (WHERE t.has_answer), '') AS pos_ids "
                "FROM questions q LEFT JOIN thits t USING (qid) GROUP BY q.qid, q.question", ["questions", "thits"])
cte("gold_in", "SELECT q.qid, q.question, replace(q.question, ' ', '  ') AS question_tokens, "
               "lower(coalesce(upper(c.title), 'NONE')) AS title, b.text AS context, CAST(q.qid AS VARCHAR) AS example_id "
               "FROM questions q JOIN benchmark b ON b.item_id = q.qid LEFT JOIN "
               "(SELECT qid, min(rank) AS rank FROM hits WHERE has_answer GROUP BY qid) f USING (qid) "
               "LEFT JOIN results r ON r.qid = f.qid AND r.rank = f.rank LEFT JOIN corpus c ON c.id = r.doc_id",
    ["questions", "hits", "results", "corpus"])

ORACLE.update({
    "s1_read_corpus": sql("SELECT id, coalesce(text, '') AS text, coalesce(title, '') AS title, row_no FROM corpus",
                          ["corpus"]),
    "s2_read_contexts": sql(f"SELECT 'wiki:' || id AS id, {n2(chr(39) + chr(34) + chr(39) + ' || text || ' + chr(39) + chr(34) + chr(39))} AS text, title FROM corpus".replace(
        "regexp_replace(regexp_replace(replace(replace('\"' || text || '\"'",
        "regexp_replace(regexp_replace(replace(replace(trim('\"' || text || '\"', '\"')"), ["corpus"]),
    "s3_read_qa_csv": sql(f"SELECT qid, question, {JOIN_ANS} AS answers, false AS parse_error FROM questions",
                          ["questions"]),
    "s4_read_qa_json": sql(f"SELECT question, {JOIN_ANS} AS answers, CAST(qid AS VARCHAR) AS entity FROM questions",
                           ["questions"]),
    "s5_read_qa_jsonl": sql(f"SELECT CAST(qid AS VARCHAR) AS id, {n1('question || ' + Q + '’s' + Q)} AS question, "
                            f"CASE WHEN len(answers) >= 2 THEN {JOIN_ANS} ELSE '' END AS answers FROM questions",
                            ["questions"]),
    "s6_read_kilt_qa": sql(f"SELECT CAST(qid AS VARCHAR) AS id, question, {JOIN_ANS} AS answers FROM questions",
                           ["questions"]),
    "s7_join_transcripts": sql(f"SELECT qid, lower(question) AS question, CAST(length(question) + 1 AS BIGINT) "
                               f"AS marker_pos, {JOIN_ANS} AS answers FROM questions", ["questions"]),
    "s8_read_datasets": sql("SELECT dataset, CAST(n AS BIGINT) AS n FROM (SELECT 'questions-test' AS dataset, count(*) AS n "
                            "FROM questions UNION ALL SELECT 'trivia-dev', count(*) FROM questions)", ["questions"]),
    "s9_read_training_json": sql("SELECT question, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_hard AS BIGINT) AS n_hard, "
                                 "pos_ids FROM tsamples WHERE n_pos > 0", ["tsamples"]),
    "s10_read_training_jsonl": sql("SELECT question, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_hard AS BIGINT) AS n_hard, "
                                   "pos_ids FROM tsamples", ["tsamples"]),
    "s11_read_table_pages": sql(
        "SELECT page_id, CAST(CASE WHEN issues THEN -1 ELSE 0 END AS BIGINT) AS table_no, "
        "CASE WHEN issues THEN NULL ELSE caption END AS caption, CASE WHEN issues THEN NULL ELSE key END AS key, "
        "CASE WHEN issues THEN 'content before any table' END AS error FROM ftables", ["ftables"]),
    "s12_read_search_results": sql(f"SELECT t.question, CAST((s.rank - 1) % {LINE} + 1 AS BIGINT) AS rank, CAST(100.0 - s.rank AS DOUBLE) AS score, s.table_id "
                                   "FROM fsearch s JOIN ftq t USING (q)", ["fsearch", "ftq"]),
    "s13_read_gold_passages": sql(
        "SELECT key, arg_max(question, qid) AS question, arg_max(title, qid) AS title, arg_max(context, qid) AS context, "
        "arg_max(example_id, qid) AS example_id FROM (SELECT question AS key, * FROM gold_in UNION ALL "
        "SELECT question_tokens AS key, * FROM gold_in) GROUP BY key", ["gold_in"]),
    "k1_result_report": sql(
        "SELECT q.qid, q.question, min(t.rank) FILTER (WHERE t.has_answer) AS hit_min_rank, "
        "coalesce(string_agg(CAST(t.rank AS VARCHAR), ',' ORDER BY t.rank) FILTER (WHERE t.has_answer), '') AS all_hits, "
        "CAST(count(t.rank) AS BIGINT) AS n_ctxs, coalesce(string_agg(t.doc_id, ',' ORDER BY t.rank), '') AS ctx_ids, "
        "CAST(coalesce(sum(length(coalesce(t.text, ''))), 0) AS BIGINT) AS text_len "
        "FROM questions q LEFT JOIN thits t USING (qid) GROUP BY q.qid, q.question", ["questions", "thits"]),
    "k2_write_recall": sql("SELECT k, round(recall, 6) AS recall FROM recall", ["recall"]),
    "k3_save_results": sql("SELECT qid, rank, doc_id, round(score, 6) AS score FROM results", ["results"]),
    "k4_index_round_trip": sql("SELECT qid, rank, doc_id, round(score, 6) AS score FROM results", ["results"]),
    "k6_qa_jsonl_to_tsv": sql("SELECT question, CASE WHEN q % 2 = 0 THEN '[''1-URGENT'']' ELSE '[]' END AS answers "
                              "FROM ftq", ["ftq"]),
    "k7_ctx_match_shards": sql(
        "SELECT CAST(row_number() OVER (ORDER BY q) - 1 AS BIGINT) AS id, "
        "CAST((row_number() OVER (ORDER BY q) - 1) // 10 AS BIGINT) AS shard, question, text FROM ("
        "SELECT f.q, t.question, f.caption || ' . ' || string_agg(array_to_string(r.vals, ' . '), '' ORDER BY r.row) "
        "|| ' . ' AS text FROM (SELECT * FROM fctx WHERE kind = 'positive' "
        "QUALIFY row_number() OVER (PARTITION BY q ORDER BY o) = 1) f JOIN ftq t USING (q) "
        "JOIN frows r ON r.page_id = f.page_id GROUP BY f.q, t.question, f.caption)", ["fctx", "ftq", "frows"]),
    "k8_kilt_provenance": sql(
        "SELECT q.qid, 'k' || q.qid AS id, q.question AS input, coalesce(string_agg((CAST(r.doc_id AS BIGINT) // 10) "
        "|| ':' || (CAST(r.doc_id AS BIGINT) % 10), ',' ORDER BY r.rank), '') AS provenance, CAST(0 AS BIGINT) AS missing "
        "FROM questions q LEFT JOIN results r USING (qid) GROUP BY q.qid, q.question", ["questions", "results"]),
})

# --- training-set preparation (R1-R8, N8, N10-N12, N15, A7, X5) ----------------------------------------
SPANS = ("flatten(list_transform(atk, lambda a: list_transform(list_filter(range(0, greatest(len(tokens) - len(a) + 1, 0)), "
         "lambda i: len(a) > 0 AND tokens[i + 1:i + len(a)] = a), lambda i: {'s': i, 'e': i + len(a) - 1})))")


def spans_str(expr: str, shift: str = "0") -> str:
    return f"array_to_string(list_transform({expr}, lambda x: (x.s + {shift}) || '-' || (x.e + {shift})), ',')"


cte("rgold", "SELECT key, arg_max(title, qid) AS title FROM (SELECT question AS key, * FROM gold_in UNION ALL "
             "SELECT question_tokens AS key, * FROM gold_in) GROUP BY key", ["gold_in"])
cte("rctx", f"SELECT h.qid, h.rank, h.doc_id, p.title, h.has_answer, {alnum('p.text')} AS tokens FROM hits h "
            "LEFT JOIN ptext p ON p.id = h.doc_id", ["hits", "ptext"])
cte("rq", f"SELECT qid, question, list_transform(answers, lambda a: {alnum('a')}) AS atk, "
          f"{alnum('question')} AS qtk FROM questions", ["questions"])
cte("rpos", f"SELECT * FROM (SELECT c.*, q.question, {SPANS} AS spans FROM rctx c JOIN rq q USING (qid) "
            "WHERE c.has_answer) WHERE len(spans) > 0", ["rctx", "rq"])
cte("rsel", "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY rank) - 1 AS BIGINT) AS ord "
            "FROM (SELECT *, max(CAST(gold AS INT)) OVER (PARTITION BY qid) AS anyg FROM "
            "(SELECT p.*, coalesce(lower(p.title) = g.title, false) AS gold FROM rpos p LEFT JOIN rgold g "
            "ON g.key = p.question)) WHERE anyg = 0 OR gold) WHERE anyg = 1 OR ord < 20", ["rpos", "rgold"])
cte("rneg", "SELECT * FROM (SELECT c.*, n.np, CAST(row_number() OVER (PARTITION BY c.qid ORDER BY c.rank) - 1 AS BIGINT) "
            "AS ord FROM rctx c JOIN (SELECT qid, count(*) AS np FROM rsel GROUP BY qid) n USING (qid) "
            "WHERE NOT c.has_answer) WHERE ord < least(greatest(np * 10, 50), 150)", ["rctx", "rsel"])
cte("rall", "SELECT qid, 'positive' AS kind, ord, doc_id, rank, title, spans FROM rsel UNION ALL "
            "SELECT qid, 'negative', ord, doc_id, rank, title, [] FROM rneg", ["rsel", "rneg"])
cte("rseq", f"SELECT a.*, 3 + len(q.qtk) + len({alnum('a.title')}) AS off, len(c.tokens) AS plen FROM rall a "
            "JOIN rq q USING (qid) JOIN rctx c ON c.qid = a.qid AND c.rank = a.rank", ["rall", "rq", "rctx"])
cte("lg", "SELECT vec_id AS pid, embedding AS s, list_reverse(embedding) AS e, len(embedding) AS n FROM embeddings")
cte("lcand", "SELECT pid, i, j, CAST(s[i + 1] AS DOUBLE) + CAST(e[j + 1] AS DOUBLE) AS score, n FROM "
             "(SELECT pid, s, e, n, i, unnest(range(i, least(i + 10, n))) AS j FROM "
             "(SELECT *, unnest(range(n)) AS i FROM lg))", ["lg"])


def keyed_position(rows: str, seed: int, epoch: int, walks: int = 6) -> str:
    """``rows`` (with x and n) with ``y``: where x stands in the keyed bijection of 0..n-1."""
    from sparkqa.functions.permute import PRIME, round_keys

    def mixed(v, k):
        t = f"(({v} * {k[0]} + {k[1]}) % {PRIME})"
        return f"((xor({t}, {t} >> 15) * {k[2]}) % {PRIME})"
    out = (f"SELECT *, x AS y, CAST(ceil(n / a::DOUBLE) AS BIGINT) AS b FROM (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM ({rows}))")
    for w in range(walks):
        out = f"SELECT *, y // b AS l, y % b AS r FROM ({out})"
        for i, k in enumerate(round_keys(seed, epoch)):
            turn = f"(l + {mixed('r', k)}) % a AS l" if i % 2 == 0 else f"(r + {mixed('l', k)}) % b AS r"
            out = f"SELECT * REPLACE ({turn}) FROM ({out})"
        inside = "y < n AND " if w else "FALSE AND "
        out = f"SELECT * EXCLUDE (l, r) REPLACE (CASE WHEN {inside}TRUE THEN y ELSE l * b + r END AS y) FROM ({out})"
    return out


def epoch_oracle(name: str, strict: bool, keyed: bool = False) -> None:
    rows = "SELECT doc_id, row_number() OVER (ORDER BY md5('8:' || doc_id), doc_id) - 1 AS p FROM documents"
    if keyed:
        rows = "SELECT doc_id, y AS p FROM (" + keyed_position(
            "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS x, count(*) OVER () AS n FROM documents", 7, 1) + ")"
    iters = "ceil(sps / 16)" if strict else "floor(sps / 16)"
    cte(name + "_p", "SELECT doc_id, p, sps, CAST(floor(p / sps) AS BIGINT) AS shard, CAST(p - floor(p / sps) * sps AS BIGINT) AS inn "
                     f"FROM (SELECT doc_id, p, CAST(ceil(count(*) OVER () / 3) AS BIGINT) AS sps FROM ({rows}))")
    cte(name + "_g", f"SELECT shard, greatest(least(sps, n - shard * sps), 0) AS len, sps, CAST({iters} AS BIGINT) AS iters "
                     f"FROM (SELECT range AS shard FROM range(3)), (SELECT count(*) AS n, max(sps) AS sps FROM {name}_p)",
        [name + "_p"])
    fill = (f" UNION ALL SELECT p.shard, nb - 1, last + p.inn, p.doc_id FROM {name}_p p JOIN "
            f"(SELECT shard, CAST(ceil(len / 16) AS BIGINT) AS nb, len - (CAST(ceil(len / 16) AS BIGINT) - 1) * 16 AS last "
            f"FROM {name}_g WHERE len > 0) g USING (shard) WHERE last < 16 AND p.inn < 16 - last") if strict else ""
    cte(name, f"SELECT shard, CAST(floor(inn / 16) AS BIGINT) AS batch, CAST(inn % 16 AS BIGINT) AS slot, doc_id "
              f"FROM {name}_p{fill} UNION ALL SELECT p.shard, b.batch, p.inn, p.doc_id FROM {name}_p p JOIN "
              f"(SELECT shard, unnest(range(CAST(ceil(len / 16) AS BIGINT), iters)) AS batch FROM {name}_g) b "
              "USING (shard) WHERE p.inn < 16", [name + "_p", name + "_g"])


epoch_oracle("ep", False)
epoch_oracle("eps", True)
epoch_oracle("epk", True, keyed=True)
cte("mixsrc", "SELECT doc_id, lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY md5('5:' || doc_id), doc_id) - 1 "
              "AS BIGINT) AS pos, count(*) OVER (PARTITION BY lang) AS n FROM documents")
cte("mixplan", "SELECT lang, n, CAST(floor(floor(n / 16) * CASE lang WHEN 'en' THEN 1.0 WHEN 'fr' THEN 0.5 "
               "WHEN 'de' THEN 0.5 WHEN 'es' THEN 0.5 ELSE 0.0 END) AS BIGINT) AS its FROM "
               "(SELECT lang, max(n) AS n FROM mixsrc GROUP BY lang)", ["mixsrc"])
cte("mixsteps", "SELECT lang, CAST(step AS BIGINT) AS step, CAST(row_number() OVER (PARTITION BY lang ORDER BY step) - 1 "
                "AS BIGINT) AS batch FROM (SELECT lang, row_number() OVER (ORDER BY md5('5:' || lang || ':' || j), lang, j) "
                "- 1 AS step FROM (SELECT lang, unnest(range(its)) AS j FROM mixplan WHERE its > 0))", ["mixplan"])
cte("mixsrck", "SELECT doc_id, lang, CAST(y AS BIGINT) AS pos, n FROM (" + keyed_position(
    "SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS x, count(*) OVER (PARTITION BY lang) AS n FROM documents", 3, 2) + ")")
cte("mixstepsk", "SELECT lang, CAST(y AS BIGINT) AS step, CAST(row_number() OVER (PARTITION BY lang ORDER BY y) - 1 AS BIGINT) AS batch FROM (" + keyed_position(
    "SELECT lang, row_number() OVER (ORDER BY lang, j) - 1 AS x, count(*) OVER () AS n FROM (SELECT lang, unnest(range(its)) AS j FROM mixplan WHERE its > 0)", 3, 2)
    + ")", ["mixplan"])
for _k in ("", "k"):
    cte("mix" + _k, "SELECT s.step, g.lang AS source, g.batch, CAST(g.slot AS BIGINT) AS slot, m.doc_id FROM "
        "(SELECT lang, n, batch, unnest(range(16)) AS slot FROM (SELECT lang, n, unnest(range(its)) AS batch "
        f"FROM mixplan WHERE its > 0)) g JOIN mixsrc{_k} m ON m.lang = g.lang AND m.pos = (g.batch * 16 + g.slot) % g.n "
        f"JOIN mixsteps{_k} s ON s.lang = g.lang AND s.batch = g.batch", ["mixplan", "mixsrc" + _k, "mixsteps" + _k])
TOKWS = r"(?:[\p{L}\p{N}\p{M}]+|[^\p{Z}\p{C}])[\p{Z}\p{C}]*"
cte("nspans", "SELECT tid, CAST(pos AS BIGINT) AS pos, regexp_extract(piece, '^(?:[\\p{L}\\p{N}\\p{M}]+|[^\\p{Z}\\p{C}])') "
              "AS token, piece, lead, last FROM (SELECT tid, lead, unnest(pcs) AS piece, "
              "unnest(range(len(pcs))) AS pos, len(pcs) - 1 AS last FROM (SELECT conv_id * 1000 + turn AS tid, "
              "length(regexp_extract(coalesce(text, ''), '^[\\p{Z}\\p{C}]*')) AS lead, "
              f"regexp_extract_all(coalesce(text, ''), '{TOKWS}') AS pcs FROM conversations))")
cte("nspans2", "SELECT tid, pos, token, CAST(lead + coalesce(sum(length(piece)) OVER (PARTITION BY tid ORDER BY pos "
               "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, "
               "CASE WHEN pos = last THEN token ELSE piece END AS text_ws FROM nspans", ["nspans"])
cte("ev", "SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_type AS tag "
          "FROM events")
cte("evisl", "SELECT *, sum(CASE WHEN prev IS NULL OR prev <> tag THEN 1 ELSE 0 END) OVER (PARTITION BY user_id "
             "ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM "
             "(SELECT *, lag(tag) OVER (PARTITION BY user_id ORDER BY pos) AS prev FROM ev)", ["ev"])

ORACLE.update({
    "n12_answer_positions": sql(f"SELECT qid, rank, doc_id, {spans_str('spans')} AS spans FROM "
                                f"(SELECT c.qid, c.rank, c.doc_id, {SPANS} AS spans FROM rctx c JOIN rq q USING (qid) "
                                "WHERE c.has_answer)", ["rctx", "rq"]),
    "r3_select_reader_passages": sql(f"SELECT qid, kind, ord, doc_id, rank, {spans_str('spans')} AS spans FROM rall",
                                     ["rall"]),
    "r3_select_reader_passages_eval": sql("SELECT qid, 'negative' AS kind, CAST(rank - 1 AS BIGINT) AS ord, doc_id, rank "
                                          "FROM results WHERE rank <= 10", ["results"]),
    "r4_reader_sequences": sql(f"SELECT qid, kind, ord, doc_id, CAST(off AS BIGINT) AS passage_offset, "
                               f"CAST(off + plen AS BIGINT) AS seq_len, off > 1 AS offset_ok, "
                               f"{spans_str('spans', 'off')} AS answer_spans FROM rseq", ["rseq"]),
    "r8_prepare_reader_data": sql("SELECT q.qid, q.question, CAST(count(*) FILTER (WHERE kind = 'positive') AS BIGINT) "
                                  "AS n_pos, CAST(count(*) FILTER (WHERE kind = 'negative') AS BIGINT) AS n_neg, "
                                  "min(doc_id) FILTER (WHERE kind = 'positive' AND ord = 0) AS first_positive "
                                  "FROM rall a JOIN questions q USING (qid) GROUP BY q.qid, q.question",
                                  ["rall", "questions"]),
    "r1_retriever_examples": sql(
        f"SELECT q.qid, {n1('q.question || ' + Q + '’' + Q, '?')} AS query, "
        "CAST(CASE WHEN count(*) FILTER (WHERE t.has_answer AND t.rank % 2 = 1) > 0 "
        "THEN count(*) FILTER (WHERE t.has_answer AND t.rank % 2 = 1) ELSE count(*) FILTER (WHERE t.has_answer) END "
        "AS BIGINT) AS n_pos, CAST(count(*) FILTER (WHERE NOT t.has_answer) AS BIGINT) AS n_hard, "
        "CAST(coalesce(CASE WHEN count(*) FILTER (WHERE t.has_answer AND t.rank % 2 = 1) > 0 "
        f"THEN sum(length({n2('t.text')})) FILTER (WHERE t.has_answer AND t.rank % 2 = 1) "
        f"ELSE sum(length({n2('t.text')})) FILTER (WHERE t.has_answer) END, 0) AS BIGINT) AS pos_chars "
        "FROM questions q LEFT JOIN thits t USING (qid) GROUP BY q.qid, q.question", ["questions", "thits"]),
    "r2_table_examples": sql(
        "SELECT p.q, t.question, l.text AS pos_text, p.caption AS pos_title, coalesce(n.titles, '') AS neg_titles, "
        "CAST(coalesce(n.chars, 0) AS BIGINT) AS neg_chars FROM "
        "(SELECT * FROM fctx WHERE kind = 'positive' QUALIFY row_number() OVER (PARTITION BY q ORDER BY o) = 1) p "
        "JOIN ftq t USING (q) JOIN flin100 l USING (q) LEFT JOIN (SELECT q, string_agg(caption, '|' ORDER BY o) AS titles, "
        "sum(chars) AS chars FROM (SELECT f.q, f.o, f.caption, (SELECT sum(length(array_to_string(r.vals, ', ')) + 1) "
        "FROM frows r WHERE r.page_id = f.page_id) AS chars FROM fctx f WHERE kind = 'hard_negative' "
        "QUALIFY row_number() OVER (PARTITION BY q ORDER BY o) <= 2) GROUP BY q) n USING (q)",
        ["fctx", "ftq", "flin100", "frows"]),
    "r5_best_spans": sql(
        "SELECT pid, CAST(coalesce(list_max(list_filter(range(0, i + 1), lambda k: k % 3 <> 2)), 0) AS BIGINT) AS start, "
        "CAST(coalesce(list_min(list_filter(range(j, n), lambda k: k = n - 1 OR (k + 1) % 3 <> 2)), j) AS BIGINT) AS \"end\", "
        "round(score, 5) AS score FROM lcand QUALIFY row_number() OVER (PARTITION BY pid ORDER BY score DESC, i, j) = 1",
        ["lcand"]),
    "n13_extend_span": sql(
        "SELECT pid, "
        + ", ".join(f"CAST(coalesce(list_max(list_filter(range(0, {i} + 1), lambda k: k % 3 <> 2)), 0) AS BIGINT) AS {c}_start, "
                    f"CAST(coalesce(list_min(list_filter(range({j}, n), lambda k: k = n - 1 OR (k + 1) % 3 <> 2)), {j}) AS BIGINT) AS {c}_end"
                    for c, i, j in (("a", 2, 3), ("b", "i", "j"))) + " FROM (SELECT *, n - 3 AS i, n - 2 AS j FROM lg WHERE n >= 6)", ["lg"]),
    "r6_epoch_shards": sql("SELECT shard, batch, slot, doc_id FROM ep", ["ep"]),
    "r6_epoch_shards_strict": sql("SELECT shard, batch, slot, doc_id FROM eps", ["eps"]),
    "r7_mix_sources": sql("SELECT step, source, batch, slot, doc_id FROM mix", ["mix"]),
    "r6_epoch_shards_keyed": sql("SELECT shard, batch, slot, doc_id FROM epk", ["epk"]),
    "r7_mix_sources_keyed": sql("SELECT step, source, batch, slot, doc_id FROM mixk", ["mixk"]),
    "a7_question_overlap": sql(
        "SELECT (SELECT count(DISTINCT question) FROM questions) AS tab_questions, "
        "(SELECT count(DISTINCT question) FROM questions WHERE len(answers) = 2 OR length(question) > 30) AS reg_questions, "
        "(SELECT count(DISTINCT question) FROM questions WHERE len(answers) = 2 OR length(question) > 30) AS overlap",
        ["questions"]),
    "x5_lookup_by_question": sql("SELECT q.qid, q.question, g.title AS gold_title FROM questions q "
                                 "LEFT JOIN rgold g ON g.key = q.question", ["questions", "rgold"]),
    "n8_token_spans": sql("SELECT tid, pos, token, start, start + length(token) AS \"end\", text_ws FROM nspans2",
                          ["nspans2"]),
    "n8_untokenize": sql("SELECT tid, trim(string_agg(text_ws, '' ORDER BY pos)) AS text FROM nspans2 GROUP BY tid",
                         ["nspans2"]),
    "n10_entity_groups": sql("SELECT user_id, CAST(isl - 1 AS BIGINT) AS group_no, string_agg(tag, ' ' ORDER BY pos) "
                             "AS text, tag, CAST(min(pos) AS BIGINT) AS start, CAST(count(*) AS BIGINT) AS n "
                             "FROM evisl WHERE tag <> 'error' GROUP BY user_id, isl, tag", ["evisl"]),
    "n11_token_position": sql("SELECT row_no, CAST(greatest(coalesce(list_position(tk, 'and'), 0) - 1, 0) AS BIGINT) "
                              "AS pos FROM dtok", ["dtok"]),
    "n15_prepare_answers": sql("SELECT conv_id, turn, array_to_string(string_split(lower(" + nfd_sql("text")
                               + "), ' '), '|') AS tokens FROM conversations", []),
})

ORACLE.update({
    "n3_normalize_nfd": sql("SELECT row_no, CAST(length(nfd) AS BIGINT) AS nfd_len, nfd <> text AS changed FROM "
                            "(SELECT row_no, text, " + nfd_sql("text") + " AS nfd FROM corpus)", ["corpus"]),
})

ORACLE["k9_reader_parts"] = ORACLE["r8_prepare_reader_data"]
ORACLE["e1_match_string_positions"] = ORACLE["e1_match_string"]
ORACLE["e6_validate_stored"] = ORACLE["e5_hit_at_k"]
ORACLE["n16_meta_text"] = sql("SELECT id, coalesce(text, '') AS plain, coalesce(title, '') || ' . ' || coalesce(text, '') AS titled FROM corpus", ["corpus"])
for _same in ("x1_bm25_topk_stream", "x1_bm25_topk_blocks", "k4_index_update"):
    ORACLE[_same] = ORACLE["x1_bm25_topk"]

ORACLE["e4_match_from_meta_compressed"] = ORACLE["e4_match_from_meta"]
ORACLE["s12_read_gold_results"] = sql(f"SELECT q AS q_index, CAST((rank - 1) % {LINE} + 1 AS BIGINT) AS rank, table_id FROM fgold", ["fgold"])

# R3 with include_gold_passage: the gold passage is the benchmark text of the question
cte("rgp", "SELECT x.qid, x.doc_id, x.text, x.spans FROM (SELECT qid, doc_id, text, " + SPANS + " AS spans FROM "
           f"(SELECT q.qid, q.atk, CAST(q.qid AS VARCHAR) AS doc_id, b.text, {alnum('b.text')} AS tokens FROM rq q "
           "JOIN benchmark b ON b.item_id = q.qid JOIN rgold g ON g.key = q.question)) x WHERE len(x.spans) > 0 "
           "AND NOT EXISTS (SELECT 1 FROM rsel s JOIN ptext p ON p.id = s.doc_id WHERE s.qid = x.qid AND p.text = x.text)",
    ["rq", "rgold", "rsel", "ptext"])
cte("rselg", "SELECT qid, ord, doc_id, rank, spans FROM rsel UNION ALL SELECT g.qid, "
             "CAST(coalesce((SELECT count(*) FROM rsel s WHERE s.qid = g.qid), 0) AS BIGINT), g.doc_id, "
             "CAST(NULL AS BIGINT), g.spans FROM rgp g", ["rsel", "rgp"])
cte("rnegg", "SELECT * FROM (SELECT c.*, n.np, CAST(row_number() OVER (PARTITION BY c.qid ORDER BY c.rank) - 1 AS BIGINT) "
             "AS ord FROM rctx c JOIN (SELECT qid, count(*) AS np FROM rselg GROUP BY qid) n USING (qid) "
             "WHERE NOT c.has_answer) WHERE ord < least(greatest(np * 10, 50), 150)", ["rctx", "rselg"])
ORACLE["r3_select_reader_passages_with_gold"] = sql(
    f"SELECT qid, 'positive' AS kind, ord, doc_id, rank, {spans_str('spans')} AS spans FROM rselg UNION ALL "
    "SELECT qid, 'negative', ord, doc_id, rank, '' FROM rnegg", ["rselg", "rnegg"])

# R5 top-3: walk each passage's candidates in (score desc, start, end) order; a candidate that
# contains or lies inside a chosen (extended) span is skipped; stop after three.
EXT_S = "coalesce(list_max(list_filter(range(0, c.i + 1), lambda k: k % 3 <> 2)), 0)"
EXT_E = "coalesce(list_min(list_filter(range(c.j, c.n), lambda k: k = c.n - 1 OR (k + 1) % 3 <> 2)), c.j)"
OVERLAP = ("len(list_filter(w.chosen, lambda p: (c.i <= p.s AND p.s <= p.e AND p.e <= c.j) OR "
           "(p.s <= c.i AND c.i <= c.j AND c.j <= p.e))) > 0")
cte("lrank", "SELECT pid, i, j, score, n, row_number() OVER (PARTITION BY pid ORDER BY score DESC, i, j) AS ci "
             "FROM lcand", ["lcand"])
cte("lwalk", "SELECT * FROM (WITH RECURSIVE w(pid, ci, chosen) AS ("
             "SELECT DISTINCT pid, CAST(0 AS BIGINT), CAST([] AS STRUCT(s BIGINT, e BIGINT, sc DOUBLE)[]) FROM lrank "
             "UNION ALL SELECT w.pid, w.ci + 1, "
             f"CASE WHEN {OVERLAP} THEN w.chosen ELSE list_append(w.chosen, "
             f"{{'s': CAST({EXT_S} AS BIGINT), 'e': CAST({EXT_E} AS BIGINT), 'sc': c.score}}) END "
             "FROM w JOIN lrank c ON c.pid = w.pid AND c.ci = w.ci + 1 WHERE len(w.chosen) < 3) "
             "SELECT pid, chosen FROM w QUALIFY row_number() OVER (PARTITION BY pid ORDER BY ci DESC) = 1)", ["lrank"])
ORACLE["r5_best_spans_top3"] = sql(
    "SELECT pid, CAST(k - 1 AS BIGINT) AS span_rank, CAST(chosen[k].s AS BIGINT) AS start, "
    "CAST(chosen[k].e AS BIGINT) AS \"end\", round(chosen[k].sc, 5) AS score FROM "
    "(SELECT pid, chosen, unnest(range(1, len(chosen) + 1)) AS k FROM lwalk)", ["lwalk"])

# the reference's own workload: top-100 retrieval and Hit@1..100
cte("results100", "SELECT qid, CAST(rank AS BIGINT) AS rank, id AS doc_id, score FROM "
                  "(SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, first_pos, row_no) "
                  "AS rank FROM bscored) WHERE rank <= 100", ["bscored"])
hits_and_recall("_100", "results100", 100)
ORACLE["x1_bm25_top100"] = sql("SELECT qid, rank, doc_id, round(score, 6) AS score FROM results100", ["results100"])
ORACLE["e5_hit_at_100"] = sql("SELECT k, hits, round(recall, 6) AS recall FROM recall_100", ["recall_100"])


def tfidf_results_oracle(suffix: str, k: int) -> None:
    cte("tranked" + suffix, "SELECT * FROM (SELECT qid, row_no, id AS doc_id, score, row_number() OVER "
                            "(PARTITION BY qid ORDER BY round(score, 9) DESC, row_no) AS rank FROM "
                            "(SELECT qid, w.row_no, c.id, sum(CAST(wq AS DOUBLE) * CAST(w AS DOUBLE)) AS score "
                            "FROM tqv JOIN tweights w USING (term) JOIN corpus c ON c.row_no = w.row_no "
                            f"GROUP BY qid, w.row_no, c.id)) WHERE rank <= {k}", ["tqv", "tweights", "corpus"])
    cte("tresults" + suffix,
        f"SELECT qid, CAST(rank AS BIGINT) AS rank, doc_id, score FROM tranked{suffix} UNION ALL "
        "SELECT qid, CAST(rank AS BIGINT), doc_id, score FROM ("
        "SELECT m.qid, m.m + row_number() OVER (PARTITION BY m.qid ORDER BY f.row_no) AS rank, f.id AS doc_id, "
        f"0.0 AS score FROM (SELECT q.qid, count(r.qid) AS m FROM questions q LEFT JOIN tranked{suffix} r USING (qid) "
        f"GROUP BY q.qid) m, (SELECT row_no, id FROM corpus ORDER BY row_no LIMIT {k}) f "
        f"WHERE m.m < {k} AND NOT EXISTS (SELECT 1 FROM tranked{suffix} r WHERE r.qid = m.qid AND r.row_no = f.row_no)) "
        f"WHERE rank <= {k}", ["tranked" + suffix, "questions", "corpus"])


tfidf_results_oracle("_k100", 100)
hits_and_recall("_t100", "tresults_k100", 100)
ORACLE["x3_tfidf_top100"] = sql("SELECT qid, rank, doc_id, round(score, 5) AS score FROM tresults_k100",
                                ["tresults_k100"])
ORACLE["e6_validate_tfidf_100"] = sql("SELECT k, hits, round(recall, 6) AS recall FROM recall_t100", ["recall_t100"])
ORACLE["e8_compare_models_100"] = sql(
    "SELECT b.k, round(b.recall, 6) AS bm25, round(t.recall, 6) AS tfidf FROM recall_100 b JOIN recall_t100 t "
    "USING (k) WHERE b.k IN (1, 10, 20, 50, 100)", ["recall_100", "recall_t100"])
ORACLE["e2_match_regex_constant"] = ORACLE["e2_match_regex"]
