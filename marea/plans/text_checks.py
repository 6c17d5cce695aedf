"""Check SQL (DuckDB) for the queries over documents, pages and vectors."""

from __future__ import annotations

from marea.functions.text import BLANKS, BOILERPLATE
from marea.operators.chunking import (CHUNK_CHARS, CHUNK_JOINER, PARAGRAPH_CHARS, PREVIEW_CHARS,
                                      PREVIEW_CHUNKS)
from marea.operators.embedding import DIMS
from marea.operators.prompts import CONTEXT_JOINER, FALLBACK, SYSTEM_TEMPLATE
from marea.plans.inputs import PARAGRAPH_BREAK, SCORE_DIGITS


def text_literal(text: str) -> str:
    """SQL text literal; control characters and the like are written as chr(n)."""
    parts, plain = [], ""
    for ch in text:
        if ch.isprintable() or ch == " ":
            plain += ch
        else:
            if plain:
                parts.append("'" + plain.replace("'", "''") + "'")
                plain = ""
            parts.append(f"chr({ord(ch)})")
    if plain or not parts:
        parts.append("'" + plain.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def paragraph_list(text: str, sep: str) -> str:
    return (f"list_filter(list_transform(string_split({text}, {text_literal(sep)}), "
            f"lambda x: trim(x, {text_literal(BLANKS)})), lambda x: x <> '')")


def content_list(text: str, sep: str) -> str:
    noise = " or ".join(f"contains(lower(x), {text_literal(p)})" for p in BOILERPLATE)
    return (f"list_filter({paragraph_list(text, sep)}, "
            f"lambda x: length(x) >= {PARAGRAPH_CHARS} and not ({noise}))")


def chunk_ctes(source: str, id_col: str, sep: str) -> str:
    """``chunks(id, chunk_no, chunk_id, chunk_text, n_chars)``: one recursion step per
    paragraph, a last step at the end to flush the open chunk."""
    join = text_literal(CHUNK_JOINER)
    fits = f"length(cur) + length(p[i]) + {len(CHUNK_JOINER)} <= {CHUNK_CHARS}"
    return f"""
  paras as (select {id_col}, {content_list('text', sep)} as p from {source}),
  steps as (
    select {id_col}, p, 1::bigint as i, ''::varchar as cur, cast(null as varchar) as emitted from paras
    union all
    select {id_col}, p, i + 1,
      case when i > len(p) then '' when {fits} and cur = '' then p[i]
           when {fits} then cur || {join} || p[i] else p[i] end,
      case when i > len(p) then cur when {fits} then null else cur end
    from steps where i <= len(p) + 1),
  chunks as (
    select {id_col}, (row_number() over (partition by {id_col} order by i) - 1)::int as chunk_no,
           emitted as chunk_text
    from steps where emitted <> '')"""


def chunk_sql(source: str, id_col: str, sep: str, prefix: str = "") -> str:
    return f"""with recursive {prefix}{chunk_ctes(source, id_col, sep)}
select {id_col}, chunk_no, md5({id_col}::varchar || '#' || chunk_no::varchar) as chunk_id,
       chunk_text, length(chunk_text)::int as n_chars from chunks"""


def bucket_ctes(name: str, source: str, key: str, text: str, dims: int = DIMS) -> str:
    """``name(key..., bucket, weight)``: hashed token counts as a unit vector."""
    return f"""
  {name}_tokens as (
    select {key}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) as token from {source}),
  {name}_counts as (
    select {key}, (('0x' || substr(md5(token), 1, 15))::bigint % {dims})::int as bucket, count(*) as c
    from {name}_tokens where token <> '' group by all),
  {name} as (
    select {key}, bucket,
           (c / sqrt((sum(c * c) over (partition by {key}))::double))::float::double as weight
    from {name}_counts)"""


def regex_chain(text: str, rules) -> str:
    for pattern, new in rules:
        # a line feed in the replacement must be a character, not an escape
        text = f"regexp_replace({text}, '{pattern.replace(chr(39), chr(39) * 2)}', {text_literal(new)}, 'g')"
    return text


# What the given pages hold, written down for the check alone: the elements and character
# references that occur there, in the order in which SQL has to take them apart.
_PAGE_RULES = (
    ("(?s)<!--.*?-->", ""), ("(?s)<script>.*?</script>", ""), ("(?s)<style>.*?</style>", ""),
    ("(?s)<nav>.*?(</nav>|$)", ""), ("<br>", "\n"),
    ("</?(p|div|article|h1|li|ul|footer|title|head|body|html)( [^>]*)?>", "\n\n"),
    ("<[^>]*>", ""), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&quot;", '"'), ("&amp;?", "&"),
    ("[ \\t\\r]*\\n[ \\t\\r]*", "\n"), ("\\n\\n+", "\n\n"), ("^\\n+", ""), ("\\n+$", ""))


def html_sql(html: str) -> str:
    return regex_chain(html, _PAGE_RULES)


LABEL_SCORES = """
  parts as (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i
            from embeddings),
  means as (select label, i, round(avg(x), 6) as x from parts group by label, i),
  questions as (select label as question, list(x order by i) as q from means group by label)"""


def _vector_topk(k: int, score: str) -> str:
    return f"""with {LABEL_SCORES},
  scored as (select question, vec_id, round({score}, {SCORE_DIGITS}) + 0.0 as score
             from embeddings, questions),
  ranked as (select *, row_number() over (partition by question order by score desc, vec_id)::int as rank
             from scored)
select question, rank, vec_id, score from ranked where rank <= {k}"""


DOT = "list_dot_product(embedding::double[], q)"
COSINE = (f"{DOT} / (sqrt(list_dot_product(embedding::double[], embedding::double[]))"
          " * sqrt(list_dot_product(q, q)))")


def topk_ctes(questions: str, question_id: str, k: int = 3) -> str:
    """``hits(question_id, rank, doc_id, chunk_no, score, chunk_text)`` over document chunks."""
    return f"""{chunk_ctes('documents', 'doc_id', PARAGRAPH_BREAK)},
  {bucket_ctes('corpus', 'chunks', 'doc_id, chunk_no', 'chunk_text')},
  {bucket_ctes('asked', questions, question_id, 'text')},
  scored as (
    select {question_id}, doc_id, chunk_no, round(sum(c.weight * a.weight), {SCORE_DIGITS}) as score
    from corpus c join asked a using (bucket) group by all),
  ranked as (
    select *, row_number() over (partition by {question_id} order by score desc, doc_id, chunk_no)::int as rank
    from scored),
  hits as (select * from ranked join chunks using (doc_id, chunk_no) where rank <= {k})"""


def context_cte(question_id: str, where: str = "true") -> str:
    return f"""
  contexts as (
    select {question_id}, string_agg(chunk_text, {text_literal(CONTEXT_JOINER)} order by rank) as context,
           count(*) as n_chunks
    from hits where {where} group by {question_id})"""


def prompt_select(questions: str, question_id: str) -> str:
    before, after = SYSTEM_TEMPLATE.replace("{fallback}", FALLBACK).split("{context}")
    return f"""
select {question_id} as conv_id, 0::bigint as turn, 'system' as role,
       {text_literal(before)} || coalesce(context, '') || {text_literal(after)} as text
from {questions} left join contexts using ({question_id})
union all
select {question_id}, 1, 'user', text from {questions}"""


_DOC_CHUNKS = chunk_sql("documents", "doc_id", PARAGRAPH_BREAK)
_CHUNK_ID = "md5(doc_id::varchar || '#' || chunk_no::varchar)"
_CHUNK_WEIGHTS = (chunk_ctes("documents", "doc_id", PARAGRAPH_BREAK) + ","
                  + bucket_ctes("corpus", "chunks", "doc_id, chunk_no", "chunk_text"))
_ITEM_HITS = f"with recursive {topk_ctes('benchmark', 'item_id')}"
_TURNS = """
  turns as (select conv_id::varchar || '-' || turn::varchar as question, text
            from conversations where role = 'user'),"""

CHECKS = {
    "split_paragraphs": f"""
with pieces as (select doc_id, {paragraph_list('text', PARAGRAPH_BREAK)} as p from documents)
select doc_id, (unnest(generate_series(1, len(p))) - 1)::int as para_no, unnest(p) as paragraph
from pieces""",
    "filter_paragraphs": f"""
with pieces as (select doc_id, {content_list('text', PARAGRAPH_BREAK)} as p from documents)
select doc_id, (unnest(generate_series(1, len(p))) - 1)::int as para_no, unnest(p) as paragraph
from pieces""",
    "chunk_documents": _DOC_CHUNKS,
    "chunk_stats": f"""
select doc_id, count(*) as n_chunks, round(sum(n_chars) / count(*), 4) as avg_chars,
       max(n_chars) as max_chars from ({_DOC_CHUNKS}) group by doc_id""",
    "chunk_stats_total": f"""
select count(*) as n_chunks, round(sum(n_chars) / count(*), 4) as avg_chars,
       max(n_chars) as max_chars from ({_DOC_CHUNKS})""",
    "chunk_preview": f"""
select doc_id, chunk_no, n_chars, substr(chunk_text, 1, {PREVIEW_CHARS}) as preview
from ({_DOC_CHUNKS}) where chunk_no < {PREVIEW_CHUNKS}""",
    "html_to_text": f"select page_id, {html_sql('html')} as text from pages",
    "html_chunks": chunk_sql("texts", "page_id", "\n\n",
                             f"texts as (select page_id, {html_sql('html')} as text from pages),"),
    "embed_hash": f"""
with {bucket_ctes('weights', 'documents', 'doc_id', 'text')}
select doc_id, bucket, round(weight, 6) as weight from weights""",
    "embedding_stats": """
with norms as (select len(embedding)::int as dims,
                      sqrt(list_dot_product(embedding::double[], embedding::double[])) as norm
               from embeddings)
select dims, count(*) as n_vectors, round(min(norm), 4) as min_norm, round(max(norm), 4) as max_norm
from norms group by dims""",
    "vector_table": f"""with recursive {_CHUNK_WEIGHTS}
select {_CHUNK_ID} as chunk_id, chunk_text, {DIMS} as dims, count(bucket)::int as n_used
from chunks left join corpus using (doc_id, chunk_no) group by doc_id, chunk_no, chunk_text""",
    "stored_topk": f"""with recursive {_CHUNK_WEIGHTS}, {bucket_ctes('asked', 'benchmark', 'item_id', 'text')},
  scored as (
    select item_id, doc_id, chunk_no, {_CHUNK_ID} as chunk_id, round(sum(c.weight * a.weight), {SCORE_DIGITS}) as score
    from corpus c join asked a using (bucket) group by item_id, doc_id, chunk_no),
  ranked as (select *, row_number() over (partition by item_id order by score desc, chunk_id)::int as rank from scored)
select item_id, rank, chunk_id, score, chunk_text from ranked join chunks using (doc_id, chunk_no) where rank <= 3""",
    "vector_topk": f"select question, rank, vec_id from ({_vector_topk(3, DOT)})",
    "vector_topk_scored": f"select * from ({_vector_topk(10, COSINE)}) where score >= 0.2",
    "chunk_topk": f"""{_ITEM_HITS}
select item_id, rank, doc_id, chunk_no, score, chunk_text from hits""",
    "rag_context": f"""{_ITEM_HITS}, {context_cte('item_id')}
select item_id, context, n_chunks from contexts""",
    "rag_answerable": f"""{_ITEM_HITS}, {context_cte('item_id', 'score >= 0.9')}
select item_id, context is not null as answerable, coalesce(n_chunks, 0) as n_chunks,
       case when context is null then {text_literal(FALLBACK)} end as reply
from benchmark left join contexts using (item_id)""",
    "rag_prompts": f"""{_ITEM_HITS}, {context_cte('item_id')}
{prompt_select('benchmark', 'item_id')}""",
    "rag_batch": f"""with recursive {_TURNS} {topk_ctes('turns', 'question')}, {context_cte('question')}
{prompt_select('turns', 'question')}""",
}
