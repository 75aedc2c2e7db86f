"""SQL statements of the text analytics."""

from oracles.products import C360
from tallyloom import labels
from tallyloom.functions.text import NEGATIVE, NEGATORS, POSITIVE, STOP_WORDS
from tallyloom.plans.textual import LABELS, QUESTION


def sql_list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def array(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def toks(c: str) -> str:
    return f"list_filter(string_split_regex(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def sents(c: str) -> str:
    return f"list_filter(list_transform(string_split_regex({c}, '[.!?\\n]+'), lambda s: trim(s)), lambda s: length(s) > 0)"


SENT = f"""words AS (SELECT feedback_id, unnest(w) AS word, unnest(list_concat([''], w[:-2])) AS before
    FROM (SELECT feedback_id, {toks('feedback_text')} AS w FROM feedback) WHERE len(w) > 0),
  polar AS (SELECT feedback_id, sum(p) AS total, count(*) AS n FROM (SELECT feedback_id,
      CASE WHEN word IN {sql_list(POSITIVE)} THEN 1 WHEN word IN {sql_list(NEGATIVE)} THEN -1 ELSE 0 END * CASE WHEN before IN {sql_list(NEGATORS)} THEN -1 ELSE 1 END AS p
      FROM words) WHERE p <> 0 GROUP BY 1),
  scored AS (SELECT f.*, coalesce(CAST(total AS DOUBLE) / n, 0.0::DOUBLE) AS s FROM feedback f LEFT JOIN polar p ON f.feedback_id = p.feedback_id)"""
LABEL = "CASE WHEN s > 0.3 THEN 'Positive' WHEN s < -0.3 THEN 'Negative' ELSE 'Neutral' END"


def vote(groups: dict, text: str, source: str, key: str) -> str:
    """Rows (key, label) of the best-matching word list."""
    parts = " UNION ALL ".join(
        f"SELECT {key}, '{name}' AS label, {i} AS place, len(list_filter(w, lambda t: list_contains({array(ws)}, t))) AS n FROM tk0" for i, (name, ws) in enumerate(groups.items())
    )
    return f"""tk0 AS (SELECT {key}, {toks(text)} AS w FROM {source}), votes AS ({parts}),
      best AS (SELECT {key}, CASE WHEN n > 0 THEN label END AS label FROM votes QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY n DESC, place) = 1)"""


def best_sentence(key: str, text: str, source: str, question: str) -> str:
    import re

    asked = array(dict.fromkeys(t for t in re.split(r"[\W_]+", question.lower()) if t))
    return f"""SELECT {key}, max(CASE WHEN r = 1 AND n > 0 THEN s END) AS answer FROM (
        SELECT {key}, s, n, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, pos) AS r FROM (
          SELECT {key}, s, pos, len(list_intersect({toks('s')}, {asked})) AS n FROM (
            SELECT {key}, unnest(ss) AS s, generate_subscripts(ss, 1) AS pos FROM (SELECT {key}, {sents(text)} AS ss FROM {source}))))
      GROUP BY 1"""


PROMPT = f"""{C360}, pr AS (SELECT customer_id, 'Customer: ' || company_name || '. Segment: ' || segment || '. Industry: ' || industry || '. MRR: $' || printf('%.2f', CAST(total_mrr AS DOUBLE)) ||
    '. Health Score: ' || coalesce(CAST(overall_health_score AS VARCHAR), 'unknown') || '. Products: ' || coalesce(products_list, 'None') ||
    '. Last Login: ' || days_since_last_login || ' days ago' AS context,
    concat_ws(chr(10), 'Write a short, helpful outreach message for this customer:', 'Customer: ' || company_name, 'Churn Risk: ' || churn_risk, 'Industry: ' || industry) AS prompt FROM c360)"""
SUMMARY = f"""parts AS (SELECT feedback_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS pos FROM (SELECT feedback_id, {sents('feedback_text')} AS ss FROM feedback WHERE length(feedback_text) > 200)),
  pw AS (SELECT feedback_id, pos, unnest({toks('s')}) AS w FROM parts), fr AS (SELECT feedback_id, w, count(*) AS c FROM pw GROUP BY 1, 2),
  sc AS (SELECT feedback_id, pos, CAST(sum(c) AS DOUBLE) / count(*) AS score FROM pw JOIN fr USING (feedback_id, w) GROUP BY 1, 2),
  top AS (SELECT p.feedback_id, p.pos, s FROM parts p LEFT JOIN sc ON p.feedback_id = sc.feedback_id AND p.pos = sc.pos
    QUALIFY row_number() OVER (PARTITION BY p.feedback_id ORDER BY coalesce(score, 0) DESC, p.pos) <= 2)"""


def digest(groups: str, source: str, k: int) -> str:
    return f"""WITH src AS ({source}), dw AS (SELECT {groups}, unnest({toks('feedback_text')}) AS term FROM src),
      tf AS (SELECT {groups}, term, count(*) AS tf FROM dw GROUP BY ALL),
      df AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({toks('feedback_text')})) AS term FROM src) GROUP BY 1),
      wt AS (SELECT {groups}, term, tf * CAST(floor(1000.0::DOUBLE * ln(CAST((SELECT count(*) FROM src) + 1 AS DOUBLE) / df)) AS BIGINT) AS w FROM tf JOIN df USING (term)),
      se AS (SELECT {groups}, feedback_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS pos FROM (SELECT {groups}, feedback_id, {sents('feedback_text')} AS ss FROM src)),
      st AS (SELECT {groups}, feedback_id, pos, s, len(list_distinct({toks('s')})) AS n, unnest(list_distinct({toks('s')})) AS term FROM se),
      sc AS (SELECT {groups}, feedback_id, pos, s, n, CAST(sum(w) AS BIGINT) // n AS score FROM st JOIN wt USING ({groups}, term) GROUP BY {groups}, feedback_id, pos, s, n),
      pick AS (SELECT *, row_number() OVER (PARTITION BY {groups} ORDER BY score DESC, feedback_id, pos) AS r FROM sc QUALIFY r <= {k}),
      sz AS (SELECT {groups}, sum(length(feedback_text)) AS chars, count(*) AS texts FROM src GROUP BY ALL)
      SELECT {groups}, texts, string_agg(s, '. ' ORDER BY r) AS digest FROM pick JOIN sz USING ({groups}) WHERE chars > 100 GROUP BY ALL"""


WEEKLY = "SELECT feedback_id, feedback_text, nps_category, CAST(date_trunc('week', submitted_date) AS DATE) AS week_start FROM feedback"


def bm25(query_tokens: str, out: str, where: str, limit: int) -> str:
    return f"""WITH q AS (SELECT DISTINCT unnest({query_tokens}) AS term), dt AS (SELECT article_id, {toks('content')} AS w FROM knowledge_base),
      post AS (SELECT article_id, len(w) AS dl, unnest(w) AS term FROM dt), tf AS (SELECT article_id, dl, term, CAST(count(*) AS DOUBLE) AS tf FROM post JOIN q USING (term) GROUP BY ALL),
      st AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(len(w)) AS DOUBLE) / count(*) AS avgl FROM dt), df AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY 1),
      sc AS (SELECT article_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgl))), 6) AS score
        FROM tf JOIN df USING (term) CROSS JOIN st GROUP BY 1)
      SELECT {out} FROM sc JOIN knowledge_base k USING (article_id) {where} ORDER BY score DESC, article_id LIMIT {limit}"""


FIRST_ITEM = toks("(SELECT text FROM benchmark ORDER BY item_id LIMIT 1)")

HELD = "(CAST('0x' || left(md5(CAST(doc_id AS VARCHAR) || ':300'), 12) AS BIGINT) % 5 = 0)"


def hashed(table: str, key: str, column: str, buckets: int) -> str:
    return f"""SELECT {key}, CAST('0x' || left(md5(t), 8) AS BIGINT) % {buckets} AS b, count(*) AS tf FROM (SELECT {key}, unnest({toks(column)}) AS t FROM {table}) GROUP BY ALL"""


SQL = {
    "index_search": bm25(FIRST_ITEM, "article_id, category, product, title, score", "", 5),
    "index_search_filtered": bm25(toks("'how is that to be with the and for'"), "article_id, product, score", "WHERE product = 'en'", 3),
    "search_batch": f"""WITH q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({toks('text')}) AS term FROM benchmark)), dt AS (SELECT article_id, {toks('content')} AS w FROM knowledge_base),
      tf AS (SELECT article_id, dl, term, CAST(count(*) AS DOUBLE) AS tf FROM (SELECT article_id, len(w) AS dl, unnest(w) AS term FROM dt) GROUP BY ALL),
      st AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(len(w)) AS DOUBLE) / count(*) AS avgl FROM dt), df AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY 1),
      sc AS (SELECT item_id, article_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgl))), 6) AS score
        FROM q JOIN tf USING (term) JOIN df USING (term) CROSS JOIN st GROUP BY ALL)
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, article_id) AS rank FROM sc QUALIFY rank <= 3""",
    "classify_trained": f"""WITH c AS ({hashed('documents', 'doc_id', 'text', 4096)}), k AS (SELECT doc_id, toxic, {HELD} AS held FROM labels WHERE toxic IS NOT NULL),
      tr AS (SELECT b, sum(tf) FILTER (toxic = 1) AS t, sum(tf) FILTER (toxic = 0) AS c FROM c JOIN k USING (doc_id) WHERE NOT held GROUP BY 1),
      se AS (SELECT r.b, CAST(coalesce(t, 0) AS DOUBLE) AS t, CAST(coalesce(c, 0) AS DOUBLE) AS c FROM (SELECT unnest(range(4096)) AS b) r LEFT JOIN tr ON r.b = tr.b),
      su AS (SELECT sum(t) AS st, sum(c) AS sc FROM se), w AS (SELECT b, ln((t + 1) / (st + 4096)) - ln((c + 1) / (sc + 4096)) AS w FROM se CROSS JOIN su),
      pr AS (SELECT ln(CAST(count(*) FILTER (toxic = 1) + 1 AS DOUBLE) / (count(*) FILTER (toxic = 0) + 1)) AS p FROM k WHERE NOT held),
      s AS (SELECT doc_id, sum(tf * w) AS s FROM c JOIN w USING (b) GROUP BY 1)
      SELECT d.doc_id, {HELD.replace('doc_id', 'd.doc_id')} AS held_out, CAST(round(coalesce(s, 0) + p, 6) > 0 AS INTEGER) AS predicted_toxic, k.toxic
      FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id CROSS JOIN pr""",
    "hashed_vectors": f"""WITH c AS ({hashed('knowledge_base', 'article_id', 'content', 768)}), f AS (SELECT b, count(*) AS df FROM c GROUP BY 1),
      x AS (SELECT article_id, b, tf * ln((CAST((SELECT count(*) FROM knowledge_base) AS DOUBLE) + 1) / (df + 1)) AS w FROM c JOIN f USING (b)),
      n AS (SELECT article_id, sqrt(sum(w * w)) AS n FROM x GROUP BY 1), g AS (SELECT article_id, unnest(range(768)) AS b FROM knowledge_base)
      SELECT g.article_id, list(round(coalesce(w / nullif(n, 0), 0), 6) ORDER BY g.b) AS embedding FROM g LEFT JOIN x ON x.article_id = g.article_id AND x.b = g.b
      LEFT JOIN n ON n.article_id = g.article_id GROUP BY 1""",
    "text_vector_search": f"""WITH c AS ({hashed('knowledge_base', 'article_id', 'content', 768)}), f AS (SELECT b, count(*) AS df FROM c GROUP BY 1),
      t AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM knowledge_base), x AS (SELECT article_id, b, tf * ln((t.n + 1) / (df + 1)) AS w FROM c JOIN f USING (b) CROSS JOIN t),
      xn AS (SELECT article_id, sqrt(sum(w * w)) AS n FROM x GROUP BY 1), v AS (SELECT article_id, b, round(coalesce(w / nullif(n, 0), 0), 6) AS v FROM x JOIN xn USING (article_id)),
      q AS ({hashed('benchmark', 'item_id', 'text', 768)}), y AS (SELECT item_id, q.b, tf * ln((t.n + 1) / (coalesce(df, 0) + 1)) AS w FROM q LEFT JOIN f ON f.b = q.b CROSS JOIN t),
      yn AS (SELECT item_id, sqrt(sum(w * w)) AS n FROM y GROUP BY 1), u AS (SELECT item_id, b, round(coalesce(w / nullif(n, 0), 0), 6) AS v FROM y JOIN yn USING (item_id)),
      vn AS (SELECT article_id, sqrt(sum(v * v)) AS n FROM v GROUP BY 1), un AS (SELECT item_id, sqrt(sum(v * v)) AS n FROM u GROUP BY 1),
      d AS (SELECT item_id, article_id, sum(u.v * v.v) AS dot FROM u JOIN v ON u.b = v.b GROUP BY 1, 2),
      s AS (SELECT item_id, article_id, round(dot / (vn.n * un.n), 6) AS similarity_score FROM d JOIN vn USING (article_id) JOIN un USING (item_id) WHERE vn.n * un.n > 0)
      SELECT item_id, article_id, similarity_score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY similarity_score DESC, article_id) AS INTEGER) AS rank
      FROM s WHERE similarity_score > 0 QUALIFY rank <= 5""",
    "sentiment": f"""WITH {SENT} SELECT feedback_id, customer_id, nps_score, left(feedback_text, 60) || '...' AS feedback_preview, round(s, 3) AS sentiment_score, {LABEL} AS sentiment_label FROM scored""",
    "sentiment_by_group": f"""WITH {SENT} SELECT nps_category, count(*) AS response_count, round(sum(s) / count(*), 4) AS avg_sentiment, round(min(s), 4) AS min_sentiment,
      round(max(s), 4) AS max_sentiment FROM scored GROUP BY 1""",
    "mismatch": f"""WITH {SENT} SELECT feedback_id, x.customer_id, company_name, segment, submitted_date, nps_score, nps_category, round(s, 6) AS sentiment_score, {LABEL} AS sentiment_category,
      CASE WHEN (nps_category = 'Promoter' AND s < 0) OR (nps_category = 'Detractor' AND s > 0) THEN '{labels.MOOD["clash"]}' ELSE '{labels.MOOD["aligned"]}' END AS alignment_flag,
      CASE WHEN s < -0.5 THEN '{labels.MOOD["escalate"]}' WHEN s < -0.2 THEN '{labels.MOOD["watch"]}' ELSE '{labels.MOOD["normal"]}' END AS escalation_risk
      FROM scored x LEFT JOIN customers c ON x.customer_id = c.customer_id""",
    "most_negative": f"WITH {SENT} SELECT feedback_id, source, round(s, 6) AS sentiment_score FROM scored ORDER BY round(s, 6), feedback_id LIMIT 20",
    "at_risk_feedback": f"""WITH {SENT} SELECT feedback_id, company_name, segment, CAST(mrr AS DOUBLE) AS mrr, health_score, nps_score, round(s, 2) AS sentiment_score,
      left(feedback_text, 80) || '...' AS feedback_preview FROM scored x JOIN customers c ON x.customer_id = c.customer_id WHERE health_score < 75 OR nps_score <= 6""",
    "language": f"WITH {vote(STOP_WORDS, 'feedback_text', 'feedback', 'feedback_id')} SELECT feedback_id, lang, label AS detected_language FROM feedback JOIN best USING (feedback_id)",
    "classify": f"""WITH {vote(LABELS, 'feedback_text', 'feedback', 'feedback_id')} SELECT feedback_id, label AS predicted_category, source AS actual_category FROM feedback JOIN best USING (feedback_id)""",
    "answers": f"SELECT article_id, answer FROM knowledge_base LEFT JOIN ({best_sentence('article_id', 'content', 'knowledge_base', QUESTION)}) USING (article_id)",
    "context_answers": f"WITH {PROMPT} {best_sentence('customer_id', 'context', 'pr', 'What products does this customer use?')}",
    "prompt_rows": f"WITH {PROMPT} SELECT * FROM pr",
    "document_summaries": f"""WITH {SUMMARY} SELECT feedback_id, string_agg(s, '. ' ORDER BY pos) AS feedback_summary FROM top GROUP BY 1
      UNION ALL SELECT feedback_id, feedback_text FROM feedback WHERE length(feedback_text) <= 200""",
    "weekly_digest": digest("week_start, nps_category", WEEKLY, 3),
    "whole_digest": digest("scope", "SELECT feedback_id, feedback_text, 'all feedback' AS scope FROM feedback", 5),
    "enrich_once": f"""WITH {SENT}, {vote(STOP_WORDS, 'feedback_text', 'feedback', 'feedback_id')} SELECT feedback_id, customer_id, submitted_date, nps_score, nps_category, round(s, 6) AS sentiment_score,
      length(feedback_text) AS chars, label AS language FROM scored JOIN best USING (feedback_id)""",
    "vector_topk": """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings), m AS (SELECT pos, avg(x) AS m FROM (
        SELECT unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e WHERE label = 0) GROUP BY 1), q AS (SELECT list(m ORDER BY pos) AS qv FROM m)
      SELECT vec_id, round(list_cosine_similarity(v, qv), 6) AS similarity_score FROM e CROSS JOIN q ORDER BY round(list_cosine_similarity(v, qv), 6) DESC, vec_id LIMIT 5""",
    "text_search": bm25(FIRST_ITEM, "article_id, category, product, title, score", "", 5),
    "text_search_filtered": bm25(toks("'how is that to be with the and for'"), "article_id, product, score", "WHERE product = 'en'", 3),
    "search_knowledge_base": bm25(FIRST_ITEM, "article_id, title, category, product, left(content, 300) || '...' AS content_excerpt, score AS relevance_score", "", 3),
    "term_statistics": f"""SELECT term, count(DISTINCT article_id) AS documents, count(*) AS occurrences FROM (SELECT article_id, unnest({toks('content')}) AS term FROM knowledge_base) GROUP BY 1""",
}
