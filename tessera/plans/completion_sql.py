"""DuckDB texts of the keyword and completion queries (the oracle side).

They state the completion rules directly in SQL -- full candidate lists,
then rank -- so they also check that the Spark side's top-k index cut is
exact.
"""

from __future__ import annotations

from tessera.functions.text import TOKEN_SPLIT
from tessera.operators.keywords import PUNCTUATION_PAIRS, RESERVED_WORDS


def _values(words) -> str:
    esc = [w.replace("'", "''") for w in words]
    return ", ".join(f"('{w}')" for w in esc)


KEYWORDS_CTE = f"keywords(word) as (values {_values(RESERVED_WORDS)})"
PUNCT_CTE = f"punct(word) as (values {_values(PUNCTUATION_PAIRS)})"


def tokens_cte(name: str, table: str, text_col: str, keep: str = "") -> str:
    keep_sel = f"{keep}, " if keep else ""
    return (f"{name}_raw as (select {keep_sel}unnest(regexp_split_to_array({text_col}, "
            f"'{TOKEN_SPLIT}')) as t from {table}),\n"
            f"{name} as (select {keep_sel}lower(trim(t)) as word from {name}_raw "
            f"where lower(trim(t)) <> '')")


KEYWORD_FREQ_CTES = ",\n".join([
    KEYWORDS_CTE,
    tokens_cte("doc_tokens", "documents", "text"),
    "kw_counts as (select word, count(*) as n from doc_tokens "
    "where word in (select word from keywords) group by word)",
    "keyword_freq as (select k.word, cast(coalesce(c.n, 0) + 1 as bigint) as cou "
    "from keywords k left join kw_counts c using (word))",
])

COMPLETION_DICT_CTES = ",\n".join([
    KEYWORD_FREQ_CTES,
    PUNCT_CTE,
    "completion_dict as (select word, cast(sum(cou) as bigint) as cou from ("
    "select word, 1 as cou from keywords union all select word, 1 from punct "
    "union all select word, cou from keyword_freq) group by word)",
])

LEARNED_DICT_CTES = ",\n".join([
    tokens_cte("doc_tokens", "documents", "text"),
    "learned_dict as (select word, count(*) as cou from doc_tokens group by word)",
])

CONV_INPUT_CTES = ",\n".join([
    tokens_cte("conv_tokens", "conversations", "text"),
    "inputs as (select distinct word as q from conv_tokens)",
])

LAST_TOKEN_CTE = (
    "last_tokens as (select conv_id, turn, case when text like '% ' then null "
    "when list_last(regexp_split_to_array(regexp_replace(text, '\\s+$', ''), '\\s')) = '' "
    "then null else list_last(regexp_split_to_array(regexp_replace(text, '\\s+$', ''), '\\s')) "
    "end as token from conversations)")


def direction_ctes(tag: str, dict_cte: str, rev: bool) -> str:
    w = "reverse(word)" if rev else "word"
    x = "reverse(q)" if rev else "q"
    return f""",
{tag}_d as (select {w} as w, word, cou from {dict_cte}),
{tag}_proper as (select w, i, substr(w, 1, i) as p
  from {tag}_d, unnest(generate_series(1, length(w) - 1)) as g(i) where length(w) >= 2),
{tag}_m as (select w, max(i) as m from {tag}_proper where p in (select w from {tag}_d) group by w),
{tag}_dm as (select d.w, d.word, d.cou, coalesce(mm.m, 0) as m
  from {tag}_d d left join {tag}_m mm using (w)),
{tag}_index as (select substr(w, 1, j) as p, word, cou
  from {tag}_dm, unnest(generate_series(greatest(1, m), length(w) - 1)) as g(j)
  where length(w) >= 2),
{tag}_nodes as (select distinct substr(w, 1, i) as p
  from {tag}_d, unnest(generate_series(1, length(w))) as g(i)),
{tag}_x as (select q, {x} as x from inputs),
{tag}_L as (select q, x, max(i) as L
  from {tag}_x, unnest(generate_series(1, length(x))) as g(i)
  where substr(x, 1, i) in (select p from {tag}_nodes) group by q, x),
{tag}_arms as (select q, substr(x, 1, L) as p from {tag}_L
  union all select q, substr(x, 1, L - 1) from {tag}_L where L > 1 and L < length(x)),
{tag}_pass as (select q, case when L > 1 and L < length(x) then L - 1 else L end as pass
  from {tag}_L),
{tag}_cand as (select a.q, i.word, i.cou from {tag}_arms a join {tag}_index i using (p))"""


def completion_sql(base_ctes: str, dict_cte: str, k: int | None, both: bool = False) -> str:
    """Ranked completions of ``inputs(q)`` against ``dict_cte(word, cou)``."""
    limit = f"where rank <= {k}" if k is not None else ""
    both_sel = ""
    if both:
        both_sel = (", exists (select 1 from h_cand hc where hc.q = r.q and hc.word = r.word) "
                    "and exists (select 1 from t_cand tc where tc.q = r.q and tc.word = r.word) "
                    "as both")
    return f"""with {base_ctes}{direction_ctes('h', dict_cte, False)}{direction_ctes('t', dict_cte, True)},
cands as (select q, word, cou from h_cand
  union all select c.q, c.word, c.cou from t_cand c join t_pass tp using (q)
  left join h_pass hp using (q) where tp.pass > coalesce(hp.pass, 0)),
merged as (select q, word, max(cou) as cou from cands group by q, word),
ranked as (select q, row_number() over (partition by q order by cou desc, word desc) as rank,
  word, cou from merged)
select r.q, r.rank, r.word, r.cou{both_sel} from ranked r {limit}"""
