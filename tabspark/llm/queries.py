"""One registered query per operator, over its whole table, with its SQL check where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabspark.llm import bpe, chat, divergence, fingerprint, language, licenses, lines, minhash, packing, phrases, quality, toxicity, urls
from tabspark.sources.io import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_packing")
def op1_packing(spark, sf_dir):
    """Every piece of every document and its bin; not in SQL: best fit goes by what was placed before."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


@query("op2_perspectives", """
with m as (select conv_id, turn, role, text from conversations group by conv_id, turn, role, text),
people as (select distinct conv_id, role as speaker from m where role <> 'system'),
seg as (
  select m.conv_id, speaker, turn, role = speaker as mine,
    '<|start|>' || case when role = speaker then 'assistant' when role = 'system' then 'system'
      else 'user name=' || role end || chr(10) as head,
    text || '<|end|>' || chr(10) as body
  from m join people p on m.conv_id = p.conv_id),
placed as (
  select *, sum(length(head) + length(body)) over (partition by conv_id, speaker order by turn
    rows between unbounded preceding and current row) as done from seg)
select conv_id, speaker, count(*) as n_messages, string_agg(head || body, '' order by turn) as text,
  string_agg(case when mine then cast(done - length(body) as bigint) || ':' || cast(done as bigint) end, ',' order by turn) as spans
from placed group by conv_id, speaker
""")
def op2_perspectives(spark, sf_dir):
    """Each dialogue from the view of each participant, with its loss spans as start:end."""
    views = chat.perspectives(read_table(spark, sf_dir, "conversations"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return views.select("conv_id", "speaker", "n_messages", "text", F.array_join(spans, ",").alias("spans"))


@query("op3_language")
def op3_language(spark, sf_dir):
    """Language of every document from dictionaries of the three folds that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    content = language.fit(docs.filter(~held))
    found = docs.select("doc_id", held.alias("held_out"), language.identify(docs, content).alias("r"))
    return found.select("doc_id", "held_out", F.col("r.lang").alias("lang_pred"), F.col("r.score").alias("score"),
                        F.col("r.margin").alias("margin"), language.rejected(F.col("r")).alias("rejected"))


@query("op4_licenses")
def op4_licenses(spark, sf_dir):
    """License phrases and notices of every document."""
    return licenses.by_document(licenses.find(read_table(spark, sf_dir, "documents")))


@query("op5_quality")
def op5_quality(spark, sf_dir):
    """Counts, base rules and compression bands of every document."""
    docs = read_table(spark, sf_dir, "documents")
    limits = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.select("doc_id", quality.rules(F.col("text"), limits).alias("q")).select("doc_id", "q.*")


@query("op6_byte_bpe")
def op6_byte_bpe(spark, sf_dir):
    """Token count and digests of the ids and of the decoded bytes of every document."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return docs.select("doc_id", bpe.round_trip(spark, F.col("text"), path, public_tokenizers.PATTERN).alias("r")).select("doc_id", "r.*")


_HOST = "translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op7_urls", f"""
with a as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
b as (select page_id, {_HOST} as host, regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) as path from a),
c as (
  select page_id, host, path, case
    when (host = 'www.example.com' or host like '%.www.example.com') and path like '/en/%' then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/en/%' then 'example.com/en/'
    when (host = 'net' or host like '%.net') and path like '/es/%' then 'net/es/'
    when (host = 'net' or host like '%.net') and path like '/fr/%' then 'net/fr/'
    when (host = 'com' or host like '%.com') and path like '/%' then 'com/' end as rule
  from b)
select page_id, host, path, rule, case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict from c
""")
def op7_urls(spark, sf_dir):
    """Rule and verdict of every page. The given pages have no canonical or redirect link, so SQL needs no components."""
    return urls.judge(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op8_fingerprints")
def op8_fingerprints(spark, sf_dir):
    """Phrase fingerprints of every document and its edited text, and likeness to it and to the next document."""
    return fingerprint.against_next(read_table(spark, sf_dir, "documents"))


@query("op9_line_dedup", f"""
with d as (select doc_id, source, text from documents),
pages as (select distinct source, text from d where text is not null and source is not null),
n as (select source, count(*) as of_pages from pages group by source),
l as (select distinct p.source, p.text as page, u.line from pages p, unnest(string_split(p.text, chr(10))) as u(line)),
c as (select source, line, count(*) as n_pages from l where regexp_matches(line, '[^ \\t-\\r]') group by source, line),
bad as (select c.source, c.line from c join n on c.source = n.source
  where n_pages >= {lines.PAGES} and n_pages >= of_pages * cast({lines.RATIO} as double)),
w as (select doc_id, source, text, unnest(string_split(text, chr(10))) as line,
  unnest(range(len(string_split(text, chr(10))))) as pos from d),
k as (select w.doc_id, pos, w.line, bad.line is null as keep from w left join bad on w.source = bad.source and w.line = bad.line)
select doc_id, coalesce(string_agg(case when keep then line end, chr(10) order by pos), '') as text,
  cast(sum(case when keep then 0 else 1 end) as bigint) as n_dropped
from k group by doc_id
""")
def op9_line_dedup(spark, sf_dir):
    """Every document without the lines its source repeats on too many pages."""
    return lines.drop_lines(read_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_dropped")


@query("op10_minhash")
def op10_minhash(spark, sf_dir):
    """Class of near-duplicate texts of every document."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


@query("op11_toxicity")
def op11_toxicity(spark, sf_dir):
    """Toxicity of every document by the lexicon of the four folds of labels that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
    lexicon = toxicity.fit(docs.filter(~held), read_table(spark, sf_dir, "labels").filter(~held))
    scored = docs.select("doc_id", held.alias("held_out"), toxicity.score(docs, lexicon).alias("r"))
    return scored.select("doc_id", "held_out", F.col("r.score").alias("score"), F.when(F.col("r.score") >= 0.5, 1).otherwise(0).alias("predicted"),
                         F.col("r.hits").alias("hits"))


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query("op12_divergence", f"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), {_LOWER}) as text, row_number() over () as row from documents),
w as (select lang, source, row, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
v as (select lang, term, count(*) as n from w group by lang, term having count(distinct row) >= {divergence.LEAST_DOCS}),
l as (select lang, count(*) as v, sum(n) as total from v group by lang),
c as (select w.lang, w.source, w.term, count(*) as n from w join v on w.lang = v.lang and w.term = v.term group by all),
t as (select lang, source, sum(n) as total from c group by all),
g as (select g.lang, g.source, coalesce(t.total, 0)::hugeint as total from (select distinct lang, source from d) g
  left join t on g.lang = t.lang and g.source = t.source),
p as (select g.lang, g.source, v.term, coalesce(c.n, 0) as n, v.n as lang_n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.total + 2 * l.v) as p, 1 + (1000000000::hugeint * (v.n + 2)) // (l.total::hugeint + 2 * l.v) as q
  from g join v on g.lang = v.lang join l on g.lang = l.lang left join c on g.lang = c.lang and g.source = c.source and v.term = c.term),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item,
    coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join p x on a.lang = x.lang and a.source = x.source
    left join p y on b.lang = y.lang and b.source = y.source and x.term = y.term group by all),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q)) // (p + q) as value from p where n > 0 and p > q)
select lang, source, part, item, cast(value as bigint) as value,
  cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
from (from pairs union all from terms) qualify part = 'pair' or row_number() over (partition by lang, source, part order by value desc, item) <= {divergence.TOP}
""")
def op12_divergence(spark, sf_dir):
    """Divergence of every two sources of a language and the terms each source overuses."""
    return divergence.audit(read_table(spark, sf_dir, "documents"))


_GRAMS = " union all ".join(
    f"select lang, {k} as k, " + " || ' ' || ".join(["w0", *(f"w{i}" for i in range(1, k))]) + f" as phrase, [{', '.join(f'w{i}' for i in range(k))}] as words from s"
    + (f" where w{k - 1} is not null" if k > 1 else "") for k in range(1, phrases.LONGEST + 1))


@query("op13_phrases", f"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), {_LOWER}) as text, row_number() over () as row from documents),
p as (select lang, row, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece,
  unnest(range(len(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')))) as part from d),
w as (select lang, row, part, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) as w0, unnest(range(len(regexp_extract_all(piece, '[^\x20\x09]+')))) as pos from p),
s as (select lang, w0, {', '.join(f"lead(w0, {i}) over (partition by row, part order by pos) as w{i}" for i in range(1, phrases.LONGEST))} from w),
f as (select lang, k, phrase, words, count(*) as f from ({_GRAMS}) group by all having count(*) >= {phrases.LEAST}),
n as (select lang, count(*) as n from w group by lang),
inner_ as (select lang, f, unnest(flatten([[words[i:i + j - 1] for i in range(1, k - j + 2)] for j in range(2, k)])) as words from f where k > 2),
c as (select f.* from f left join (select lang, words, max(f) as longer from inner_ group by all) i on f.lang = i.lang and f.words = i.words
  where k > 1 and (longer is null or 100 * longer < {phrases.COVERED} * f.f)),
x as (select c.lang, c.k, c.phrase, c.words, c.f, unnest(range(1, c.k)) as cut from c),
y as (select x.lang, x.phrase, x.f as a, l.f as l, r.f as r, n.n, cut, (1000::hugeint * x.f * n.n) // (l.f::hugeint * r.f) as score from x
  join f l on x.lang = l.lang and l.words = x.words[1:cut] join f r on x.lang = r.lang and r.words = x.words[cut + 1:x.k] join n on n.lang = x.lang),
z as (select * from y qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, cast(score as bigint) as score
from z qualify rank <= {phrases.RANKS}
""")
def op13_phrases(spark, sf_dir):
    """The strongest collocations of each language."""
    return phrases.collocations(read_table(spark, sf_dir, "documents"))
