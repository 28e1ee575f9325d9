"""Checking SQL for DuckDB, written from the operators' definitions.

`CTES` holds named building blocks; `sql(body)` prepends those the body names, directly or through others.
"""

from __future__ import annotations

import re

from newsgraph import lexicon as lx


def _list(words: list[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def q(pattern: str) -> str:
    """A pattern as SQL string literal."""
    return "'" + pattern.replace("'", "''") + "'"


STOP = _list(lx.STOP_WORDS)
SPLIT = q(rf"[{lx.SPACE}]+")


def tokens_of(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, {SPLIT}), lambda t: t <> '')"


def special(expr: str) -> str:
    return f"regexp_replace({expr}, {q(rf'[^{lx.WORD}{lx.SPACE}]')}, ' ', 'g')"


def urls(expr: str) -> str:
    return f"regexp_replace({expr}, {q(lx.URL)}, ' ', 'g')"


def digits(expr: str) -> str:
    return f"regexp_replace({expr}, '\\p{{Nd}}+', ' ', 'g')"


def hyphens(expr: str) -> str:
    pattern = q(rf"([{lx.WORD}])-([{lx.WORD}])")
    once = f"regexp_replace({expr}, {pattern}, '\\1 \\2', 'g')"
    return f"regexp_replace({once}, {pattern}, '\\1 \\2', 'g')"


def clean_list(expr: str) -> str:
    """The cleaning steps one after the other."""
    stepped = f"lower({digits(hyphens(special(urls(expr))))})"
    return f"list_filter({tokens_of(stepped)}, lambda w: w NOT IN {STOP})"


def clean(expr: str) -> str:
    return f"array_to_string({clean_list(expr)}, ' ')"


def sentences_of(expr: str) -> str:
    found = f"regexp_extract_all({expr}, {q(lx.SENTENCE)}, 0)"
    ends = q(rf"^[{lx.SPACE}]+|[{lx.SPACE}]+$")
    return (
        f"list_filter(list_transform({found}, lambda s: regexp_replace(s, {ends}, '', 'g')), lambda s: s <> '')"
    )


def words_of(expr: str) -> str:
    return f"regexp_extract_all({expr}, {q(lx.TOKEN)}, 0)"


def _pos_case(word: str) -> str:
    parts = [f"WHEN NOT regexp_full_match({word}, {q(f'[{lx.WORD}]+')}) THEN 'PUNCT'",
             f"WHEN regexp_full_match({word}, '\\p{{Nd}}+') THEN 'NUM'"]
    parts += [f"WHEN {word} IN {_list(words)} THEN '{name}'" for name, words in lx.CLOSED_CLASSES.items()]
    parts += [f"WHEN length({word}) >= {len(s) + 2} AND suffix({word}, '{s}') THEN '{name}'" for s, name in lx.SUFFIXES]
    return "CASE " + " ".join(parts) + " ELSE 'NOUN' END"


def _lemma_case(word: str) -> str:
    return "CASE " + " ".join(f"WHEN {word} = '{w}' THEN '{m}'" for w, m in lx.ANCHORS.items()) + f" ELSE {word} END"


def _label_case(piece: str) -> str:
    return "CASE " + " ".join(
        f"WHEN regexp_full_match({piece}, {q(p)}) THEN '{name}'" for name, p in lx.ATTRIBUTE_PATTERNS
    ) + " END"


# the scanner without its shortcut for plain words
_PIECE = lx.PIECE.removeprefix(rf"{lx._PLAIN_START}{lx._REST}|")
_TYPE_LIST = "[" + ", ".join(f"'{t}'" for t in lx.ENTITY_TYPES) + "]"
_ALL_TYPES = "[" + ", ".join(f"'{t}'" for t in lx.ENTITY_TYPES + lx.ATTRIBUTE_TYPES) + "]"
_CONFIDENCE = (
    "greatest(0.1::DOUBLE, least(1.0::DOUBLE, ((0.3::DOUBLE + 0.4::DOUBLE) + "
    f"CASE WHEN lemma IN {_list(lx.BONUS_LEMMAS)} THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END) "
    "- least(0.3::DOUBLE, 0.05::DOUBLE * (abs(root_i - subject_i) + abs(root_i - object_i)))))"
)


def taken_hits(hits: str) -> str:
    """From the longest hit to the shortest, from left to right, whatever overlaps none taken before."""
    return f"""
        SELECT article_id, h.pos AS pos, h.words AS words, h.text AS text, h.label AS label FROM (
            SELECT article_id, unnest(list_reduce(
                list([{{'pos': pos, 'words': words, 'text': text, 'label': label}}]
                     ORDER BY words DESC, pos, list_position({_ALL_TYPES}, label)),
                lambda taken, x: taken || list_filter(x, lambda h: len(list_filter(taken, lambda t:
                    t.pos < h.pos + h.words AND h.pos < t.pos + t.words)) = 0))) AS h
            FROM {hits} GROUP BY article_id)"""


def mention_ctes(prefix: str, source: str, text: str, capitalised: bool = True) -> dict[str, str]:
    """pieces -> hits -> longest -> mentions over a text column."""
    first = "\\p{Lu}.*" if capitalised else ".*"

    def word(piece: str) -> str:
        return f"regexp_full_match({piece}, {q(f'[{lx.WORD}]+')})"

    return {
        f"{prefix}pieces": f"""
            SELECT article_id, pos, piece,
                   lead(piece, 1) OVER (PARTITION BY article_id ORDER BY pos) AS piece2,
                   lead(piece, 2) OVER (PARTITION BY article_id ORDER BY pos) AS piece3,
                   lead(piece, 3) OVER (PARTITION BY article_id ORDER BY pos) AS piece4
            FROM (SELECT article_id, unnest(p) AS piece, unnest(range(len(p))) AS pos
                  FROM (SELECT article_id, regexp_extract_all({text}, {q(_PIECE)}, 0) AS p FROM {source}))""",
        f"{prefix}attributes": f"""
            SELECT * FROM (SELECT article_id, pos, 1 AS words, piece AS text, {_label_case('piece')} AS label
                           FROM {prefix}pieces) WHERE label IS NOT NULL""",
        f"{prefix}starts": f"""
            SELECT * FROM {prefix}pieces WHERE {word('piece')} AND regexp_full_match(piece, '(?s){first}')""",
        f"{prefix}grams": f"""
            SELECT article_id, pos, 1 AS words, piece AS text FROM {prefix}starts
            UNION ALL
            SELECT article_id, pos, 2, piece || ' ' || piece2 FROM {prefix}starts WHERE {word('piece2')}
            UNION ALL
            SELECT article_id, pos, 3, piece || ' ' || piece2 || ' ' || piece3 FROM {prefix}starts
            WHERE {word('piece2')} AND {word('piece3')}
            UNION ALL
            SELECT article_id, pos, 4, piece || ' ' || piece2 || ' ' || piece3 || ' ' || piece4 FROM {prefix}starts
            WHERE {word('piece2')} AND {word('piece3')} AND {word('piece4')}""",
        f"{prefix}gazhits": f"""
            SELECT g.article_id, g.pos, g.words, g.text, z.label
            FROM {prefix}grams g JOIN gazetteer z ON lower(g.text) = z.term""",
        f"{prefix}hits": f"SELECT * FROM {prefix}gazhits UNION ALL SELECT * FROM {prefix}attributes",
        f"{prefix}mentions": taken_hits(f"{prefix}hits"),
        f"{prefix}entities": taken_hits(f"{prefix}gazhits"),
    }


CTES: dict[str, str] = {
    "articles": "SELECT doc_id AS article_id, doc_id AS ord, source || '/' || doc_id AS url, text FROM documents",
    "all_turns": "SELECT conv_id * 1000 + turn AS article_id, text AS \"Sentence\" FROM conversations",
    "turns": """
        SELECT conv_id * 1000 + turn AS article_id, CASE WHEN role <> 'user' THEN text END AS "Sentence"
        FROM conversations""",
    "triples": """
        SELECT event_id AS id, 'user ' || user_id AS entity1, event_type AS predicate, props AS entity2 FROM events""",
    "item_grams": f"""
        SELECT item_id, lower(array_to_string(t[i:i + n - 1], ' ')) AS term
        FROM (SELECT item_id, t, unnest(range(1, len(t) + 1)) AS i
              FROM (SELECT item_id, {words_of('s')} AS t FROM (SELECT item_id, unnest({sentences_of('text')}) AS s FROM benchmark))),
             (VALUES (1), (2), (3), (4)) v(n)
        WHERE len(t) >= i + n - 1 AND len(list_filter(t[i:i + n - 1], lambda w: NOT regexp_full_match(w, {q(f'[{lx.WORD}]+')}))) = 0""",
    "gazetteer": f"SELECT DISTINCT term, {_TYPE_LIST}[length(term) % {len(lx.ENTITY_TYPES)} + 1] AS label FROM item_grams",
    "catalogue": f"""
        SELECT CASE WHEN length(term) > 5 THEN term || ' ' ELSE term END AS label,
               CASE WHEN length(term) <> 2 THEN 'Q' || item_id END AS item,
               CASE WHEN substr(term, 1, 1) NOT IN ('e', 'o') THEN n::DOUBLE / (n + 2) END AS score
        FROM (SELECT item_id, term, count(*) AS n FROM (
                SELECT item_id, unnest({tokens_of(f"lower({special('text')})")}) AS term FROM benchmark
                UNION ALL SELECT item_id, term FROM item_grams) GROUP BY item_id, term)""",
    "sents": f"""
        SELECT article_id, unnest(s) AS sentence, unnest(range(len(s))) AS sent
        FROM (SELECT article_id, {sentences_of("coalesce(text, '')")} AS s FROM articles)""",
    # -- summary
    "sentence_terms": f"""
        SELECT article_id, sent, w, count(*) AS tf
        FROM (SELECT article_id, sent, unnest(regexp_extract_all(lower(sentence), {q(lx.SUMMARY_WORD)}, 0)) AS w FROM sents)
        GROUP BY article_id, sent, w""",
    "sentence_scores": """
        SELECT s.article_id, s.sent, any_value(s.sentence) AS sentence,
               coalesce(round(sum((0.4::DOUBLE + 0.6::DOUBLE * t.tf / t.m) ** 2 - 0.16::DOUBLE), 9), 0.0) AS score
        FROM sents s LEFT JOIN (
            SELECT *, max(tf) OVER (PARTITION BY article_id, sent) AS m FROM sentence_terms) t
          ON s.article_id = t.article_id AND s.sent = t.sent
        GROUP BY s.article_id, s.sent""",
    "best_sentences": """
        SELECT article_id, sentence, score FROM (
            SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY score DESC, sent) AS rn FROM sentence_scores)
        WHERE rn = 1""",
    "summaries": """
        SELECT a.article_id, a.ord, a.url, a.text, coalesce(b.sentence, a.text) AS summary
        FROM articles a LEFT JOIN best_sentences b ON a.article_id = b.article_id""",
    "turn_sents": f"""
        SELECT article_id, unnest(s) AS sentence, unnest(range(len(s))) AS sent
        FROM (SELECT article_id, {sentences_of("coalesce(\"Sentence\", '')")} AS s FROM turns)""",
    "turn_terms": f"""
        SELECT article_id, sent, w, count(*) AS tf, max(count(*)) OVER (PARTITION BY article_id, sent) AS m
        FROM (SELECT article_id, sent, unnest(regexp_extract_all(lower(sentence), {q(lx.SUMMARY_WORD)}, 0)) AS w FROM turn_sents)
        GROUP BY article_id, sent, w""",
    "turn_scores": """
        SELECT article_id, sent, round(sum((0.4::DOUBLE + 0.6::DOUBLE * tf / m) ** 2 - 0.16::DOUBLE), 9) AS score
        FROM turn_terms GROUP BY article_id, sent""",
    "turn_ranked": """
        SELECT s.article_id, s.sentence, row_number() OVER (
            PARTITION BY s.article_id ORDER BY coalesce(c.score, 0) DESC, s.sent) AS rn
        FROM turn_sents s LEFT JOIN turn_scores c ON c.article_id = s.article_id AND c.sent = s.sent""",
    "turn_best": """
        SELECT t.article_id, t."Sentence" AS original, b.sentence AS best
        FROM turns t LEFT JOIN turn_ranked b ON b.article_id = t.article_id AND b.rn = 1""",
    # -- annotation
    "word_rows": f"""
        SELECT article_id, sent, k, row_number() OVER (PARTITION BY article_id ORDER BY sent, k) - 1 AS i, token, lower(token) AS word
        FROM (SELECT article_id, sent, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS k
              FROM (SELECT article_id, sent, {words_of('sentence')} AS t FROM sents))""",
    "tagged": f"""
        SELECT *, {_pos_case('word')} AS pos, {_lemma_case('word')} AS lemma,
               NOT regexp_full_match(word, {q(f'[{lx.WORD}]+')}) AS is_punct, word IN {STOP} AS is_stop,
               word IN {_list(list(lx.ANCHORS))} AS is_anchor
        FROM word_rows""",
    "roots": """
        SELECT article_id, sent, min(i) AS root_i FROM tagged WHERE is_anchor GROUP BY article_id, sent""",
    "arguments": """
        SELECT t.article_id, t.sent, r.root_i,
               max(t.i) FILTER (t.i < r.root_i) AS subject_i, min(t.i) FILTER (t.i > r.root_i) AS object_i
        FROM tagged t JOIN roots r ON t.article_id = r.article_id AND t.sent = r.sent
        WHERE NOT t.is_punct AND NOT t.is_stop AND NOT t.is_anchor
        GROUP BY t.article_id, t.sent, r.root_i""",
    "tokens": """
        SELECT t.article_id, t.sent, t.i, t.token AS text, t.lemma, t.pos,
               CASE WHEN t.i = r.root_i THEN 'ROOT' WHEN t.i = a.subject_i THEN 'nsubj'
                    WHEN t.i = a.object_i THEN 'dobj' ELSE 'dep' END AS dep,
               coalesce(r.root_i, t.i) AS head_i, t.is_stop, t.is_punct
        FROM tagged t LEFT JOIN roots r ON t.article_id = r.article_id AND t.sent = r.sent
        LEFT JOIN arguments a ON t.article_id = a.article_id AND t.sent = a.sent""",
    "all_relations": f"""
        SELECT article_id, sent, pos, subject, predicate, object, {_CONFIDENCE} AS confidence FROM (
            SELECT r.article_id, r.sent, r.i - f.first_i AS pos, r.i AS root_i, s.i AS subject_i, o.i AS object_i,
                   s.text AS subject, r.text AS predicate, o.text AS object, r.lemma
            FROM tokens r
            JOIN (SELECT article_id, sent, min(i) AS first_i FROM tokens GROUP BY article_id, sent) f
              ON f.article_id = r.article_id AND f.sent = r.sent
            JOIN (SELECT article_id, head_i, min(i) AS i FROM tokens WHERE dep IN ('nsubj', 'nsubjpass') AND i < head_i
                  GROUP BY article_id, head_i) si ON si.article_id = r.article_id AND si.head_i = r.i
            JOIN (SELECT article_id, head_i, min(i) AS i FROM tokens WHERE dep IN ('dobj', 'pobj') AND i > head_i
                  GROUP BY article_id, head_i) oi ON oi.article_id = r.article_id AND oi.head_i = r.i
            JOIN tokens s ON s.article_id = r.article_id AND s.i = si.i
            JOIN tokens o ON o.article_id = r.article_id AND o.i = oi.i
            WHERE r.dep = 'ROOT')""",
    # -- mentions
    **mention_ctes("doc_", "articles", "text"),
    **mention_ctes("sum_", "summaries", "summary"),
    "raw_turns": "SELECT article_id, coalesce(\"Sentence\", '') AS text FROM turns",
    **mention_ctes("raw_turn_", "raw_turns", "text"),
    # -- linking
    "candidates": """
        SELECT lower(trim(label)) AS key, label, item, score FROM catalogue""",
    "mention_texts": "SELECT text, count(*) AS n FROM doc_mentions GROUP BY text",
    "pairs": """
        SELECT m.text, m.n, c.label, c.item, c.score,
               row_number() OVER (PARTITION BY m.text ORDER BY c.score DESC NULLS LAST, c.item ASC NULLS LAST, c.label) AS rank
        FROM mention_texts m JOIN candidates c ON lower(trim(m.text)) = c.key""",
    # Texts meet labels that differ in trailing blanks only, so all characters of the text match: 2 * matched / total.
    "links": """
        SELECT text, n, CASE WHEN item IS NULL THEN '' ELSE item END AS uri,
               CASE WHEN item IS NULL THEN 0.1::DOUBLE
                    ELSE coalesce(score, 2.0::DOUBLE * length(text) / (length(text) + length(label))) END AS confidence
        FROM pairs WHERE rank = 1""",
    "linked": """
        SELECT m.article_id, m.pos, m.text, m.label AS type, l.uri, l.confidence
        FROM doc_mentions m JOIN links l ON m.text = l.text WHERE l.confidence >= 0.5::DOUBLE""",
    "relations": """
        SELECT * FROM all_relations r WHERE confidence >= 0.4::DOUBLE
          AND EXISTS (SELECT 1 FROM linked l WHERE l.article_id = r.article_id)""",
    # -- knowledge base
    "arrivals": """
        SELECT l.*, a.ord, a.url AS article_url FROM linked l JOIN articles a ON a.article_id = l.article_id""",
    "triple_arrivals": """
        SELECT r.*, a.ord, a.url AS article_url FROM relations r JOIN articles a ON a.article_id = r.article_id""",
    "firsts": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY type, text ORDER BY ord, pos) AS rn FROM arrivals)
        WHERE rn = 1""",
    "kb_entities": f"""
        SELECT f.type, f.text, f.uri, g.confidence, g.n AS confidence_counts,
               CASE WHEN f.type IN {_list(lx.ENTITY_TYPES)} THEN 'entities' ELSE 'attributes' END AS category
        FROM firsts f JOIN (SELECT type, text, avg(confidence) AS confidence, count(*) AS n FROM arrivals
                            GROUP BY type, text) g ON g.type = f.type AND g.text = f.text""",
    "kb_nodes": f"""
        SELECT node_id, type, text, CASE WHEN type IN {_list(lx.ENTITY_TYPES)} THEN 'entities' ELSE 'attributes' END AS category,
               article_url, confidence FROM (
            SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY ord DESC, pos DESC) AS last_rn FROM (
                SELECT *, CASE WHEN coalesce(uri, '') <> '' THEN uri ELSE type || '_' || text END AS node_id FROM firsts))
        WHERE last_rn = 1""",
    "kb_edges": """
        SELECT subject, object, predicate AS relation, confidence, article_url FROM (
            SELECT *, row_number() OVER (PARTITION BY subject, object ORDER BY ord DESC, sent DESC, pos DESC) AS rn
            FROM triple_arrivals) WHERE rn = 1""",
    "kb_endpoints": """
        SELECT node_id FROM (SELECT subject AS node_id FROM kb_edges UNION SELECT object FROM kb_edges)
        WHERE node_id NOT IN (SELECT node_id FROM kb_nodes)""",
    # -- TF-IDF
    "term_counts": f"""
        SELECT article_id, term, count(*) AS tf
        FROM (SELECT article_id, unnest(regexp_extract_all(lower(text), {q(lx.TERM)}, 0)) AS term FROM articles)
        GROUP BY article_id, term""",
    "idf": """
        SELECT term, count(*) AS df, ln((1 + (SELECT count(*) FROM articles))::DOUBLE / (1 + count(*))) + 1 AS idf
        FROM term_counts GROUP BY term""",
    "raw_weights": """
        SELECT c.article_id, c.term, i.df, c.tf * i.idf AS raw FROM term_counts c JOIN idf i ON i.term = c.term""",
    "weights": """
        SELECT article_id, term, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY article_id)) AS w FROM raw_weights""",
    # -- splits
    "kept_triples": """
        SELECT * FROM triples WHERE entity1 IS NOT NULL AND predicate IN (
            SELECT predicate FROM triples WHERE entity1 IS NOT NULL GROUP BY predicate HAVING count(*) > 1)""",
    "ranked_triples": """
        SELECT *, row_number() OVER (PARTITION BY predicate ORDER BY md5(concat_ws('|', '42', id::VARCHAR)), id) AS r,
               count(*) OVER (PARTITION BY predicate) AS m FROM kept_triples""",
    "split_triples": """
        SELECT id, entity1, predicate, entity2,
               CASE WHEN r <= m - h THEN 'train' WHEN r <= m - (h + 1) // 2 THEN 'valid' ELSE 'test' END AS split
        FROM (SELECT *, (2 * m + 5) // 10 AS h FROM ranked_triples)""",
    "random_triples": """
        SELECT id, CASE WHEN r <= m - h THEN 'train' WHEN r <= m - (h + 1) // 2 THEN 'valid' ELSE 'test' END AS split
        FROM (SELECT *, (2 * m + 9) // 10 AS h FROM (
            SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', id::VARCHAR)), id) AS r,
                   count(*) OVER () AS m FROM kept_triples))""",
    "small_train": """
        SELECT id, entity1, predicate, entity2 FROM (
            SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', 'sample', '42', id::VARCHAR)), id) AS r,
                   count(*) OVER () AS m FROM split_triples WHERE split = 'train')
        WHERE r <= round(0.05::DOUBLE * m)""",
    "label_codes": """
        SELECT predicate, row_number() OVER (ORDER BY predicate) - 1 AS code
        FROM (SELECT DISTINCT predicate FROM split_triples WHERE split = 'train')""",
}

def refresh() -> None:
    """Call after adding to `CTES`."""
    global _NAME
    _NAME = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


refresh()


def sql(body: str) -> str:
    """`body` with the building blocks it needs in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name not in needed:
                visit_name(name)

    open_names: set[str] = set()

    def visit_name(name: str) -> None:
        if name in open_names:
            return
        open_names.add(name)
        visit(CTES[name])
        open_names.discard(name)
        if name not in needed:
            needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n].strip()})" for n in needed) + "\n" + body
