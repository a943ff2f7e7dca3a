"""DuckDB SQL for the derived test tables (same formulas as sources.tables)."""

CONTENT = """(select doc_id as id,
        string_split(text, chr(10))[1] as title,
        'doc:' || source || '/' || cast(doc_id as varchar) as uri,
        text as body_text,
        n_chars as structure_size,
        cast(substr(source, 4, 10) as integer) as source_id,
        cast(date '2020-01-01' + cast((doc_id * 7919) % 1500 as integer) as date) as last_updated
   from documents)"""

CONTENT_IDX = f"""(select c.*, case when l.doc_id is not null
            then cast(c.last_updated + 1 as date) end as index_date
   from {CONTENT} c left join (select doc_id from labels) l on c.id = l.doc_id)"""

SOURCE = """(select cast(substr(source, 4, 10) as integer) as id, source as label
   from (select distinct source from documents) where source <> 'src19')"""


def abbreviation_scores(src: str, text: str = "text") -> str:
    """(word, n, n_dot, score) of the words a period follows, in DuckDB."""
    return f"""(with h as (select unnest(regexp_extract_all({text}, '\\p{{L}}+(?:\\.\\p{{L}}+)*\\.?')) as h from {src}),
  c as (select lower(rtrim(h, '.')) as word, count(*) as n, count(*) filter (where h like '%.') as n_dot from h group by 1),
  t as (select sum(n_dot) / sum(n) as p from c),
  b as (select *, length(replace(word, '.', '')) as bare from c where n_dot > 0)
  select word, n, n_dot, 2 * (n_dot * (ln(0.99) - ln(p)) + (n - n_dot) * (ln(0.01) - ln(1 - p)))
         * exp(-bare) * (length(word) - bare + 1) * exp(-(n - n_dot) * ln(bare)) as score from b, t)"""


def sentences(src: str, id_col: str = "doc_id", text: str = "text", learned: str | None = None) -> str:
    """Sentence rows (id, sentence, begin, end, result) of ``src`` in DuckDB;
    ``learned`` is a scalar query for the pattern of learned abbreviations."""
    from docweave.operators.segment import ABBREVIATIONS, SENTENCE_BREAK
    abbr = "|".join(ABBREVIATIONS)
    unbroken = f"'(^|[^\\p{{L}}])({abbr})\\.(\\s+)'"
    if learned:
        unbroken = f"'(?i)(^|[^\\p{{L}}])(' || {learned} || ')\\.(\\s+)'"
    return f"""(with m as (
    select {id_col}, regexp_replace(regexp_replace(regexp_replace({text}, '{SENTENCE_BREAK}', '\\1' || chr(1), 'g'),
        {unbroken} || chr(1), '\\1\\2.\\3', 'g'), {unbroken} || chr(1), '\\1\\2.\\3', 'g') as marked from {src}),
  p as (select {id_col}, unnest(string_split(marked, chr(1))) as piece,
               generate_subscripts(string_split(marked, chr(1)), 1) as pos from m),
  o as (select {id_col}, pos, regexp_replace(piece, '^\\s+|\\s+$', '', 'g') as result,
          sum(length(piece)) over (partition by {id_col} order by pos
              rows between unbounded preceding and current row) - length(piece)
          + length(regexp_extract(piece, '^\\s*', 0)) as begin from p)
  select {id_col}, cast(row_number() over (partition by {id_col} order by pos) - 1 as integer) as sentence,
         cast(begin as integer) as begin, cast(begin + length(result) - 1 as integer) as "end", result
  from o where result <> '')"""


def tokens(src: str, id_col: str = "doc_id", text: str = "text", scope: str = "document",
           context_chars: str | None = None) -> str:
    """Token rows (id, sentence, pos, begin, end, result) in DuckDB."""
    from docweave.operators.segment import token_pattern
    pat = token_pattern(context_chars)
    if scope == "document":
        base = f"(select {id_col}, 0 as sentence, 0 as base, {text} as t from {src})"
    else:
        base = f"(select {id_col}, sentence, begin as base, result as t from {sentences(src, id_col, text)})"
    return f"""(with p as (
    select {id_col}, sentence, base, unnest(regexp_extract_all(t, '{pat}')) as piece,
           generate_subscripts(regexp_extract_all(t, '{pat}'), 1) as i from {base}),
  o as (select {id_col}, sentence, i, regexp_replace(piece, '^\\s+', '') as tok,
          base + sum(length(piece)) over (partition by {id_col}, sentence order by i
              rows between unbounded preceding and current row) as upto from p)
  select {id_col}, cast(sentence as integer) as sentence, cast(i - 1 as integer) as pos,
         cast(upto - length(tok) as integer) as begin, cast(upto - 1 as integer) as "end", tok as result
  from o)"""


def greedy(matches: str, part: str, order: str, cols: str) -> str:
    """The rows of ``matches`` (with begin and e_) taken from the left, each
    unless it overlaps the one taken before: a chain over "next row that begins
    behind this one's end" from the first row of each ``part``."""
    return f"""(with recursive m as (
    select *, row_number() over (partition by {part} order by {order}) as rn from {matches}),
  nx as (select a.*, (select min(b.rn) from m b where {' and '.join(f'b.{c.strip()} = a.{c.strip()}' for c in part.split(','))}
                        and b.begin > a.e_) as next_rn from m a),
  taken as (
    select * from nx where rn = 1
    union all
    select nx.* from taken t join nx on {' and '.join(f'nx.{c.strip()} = t.{c.strip()}' for c in part.split(','))} and nx.rn = t.next_rn)
  select {cols} from taken)"""


def rule_spans(src: str, id_col: str = "doc_id", text: str = "text") -> str:
    """Resolved rule hits (id, begin, end, result, entity, priority) in DuckDB."""
    from docweave.operators.entities import RULES
    per_rule = " union all ".join(
        f"select {id_col}, {text} as body, '{name}' as entity, {prio} as priority, "
        f"regexp_split_to_array({text}, '{pat}') as g, regexp_extract_all({text}, '{pat}') as m from {src}"
        for prio, (name, pat) in enumerate(RULES))
    found = f"""(with r as ({per_rule}),
  e as (select {id_col}, body, entity, priority, unnest(m) as result, unnest(list_slice(g, 1, len(m))) as gap,
               generate_subscripts(m, 1) as i from r where len(m) > 0),
  o as (select {id_col}, body, entity, priority, result,
          sum(length(gap) + length(result)) over (partition by {id_col}, entity order by i
              rows between unbounded preceding and current row) - length(result) as begin from e)
  select {id_col}, entity, priority, result, begin, begin + length(result) - 1 as e_ from o
  where (entity not in ('IP', 'CARD', 'KEY')
         or not regexp_matches(case when begin > 0 then substr(body, cast(begin as bigint), 1) else '' end
                               || substr(body, cast(begin + length(result) + 1 as bigint), 1), '[0-9A-Za-z]'))
    and (entity <> 'IP' or list_max(list_transform(string_split(result, '.'), lambda x: cast(x as integer))) <= 255))"""
    return greedy(found, id_col, "begin, e_ desc, priority",
                  f'{id_col}, cast(begin as integer) as begin, cast(e_ as integer) as "end", result, entity, priority')


def spans_with_sentences(spans: str, sentences_: str, id_col: str = "doc_id") -> str:
    return f"""(with u as (
    select {id_col}, begin, "end", result, entity, priority, 1 as kind, cast(null as integer) as sentence from {spans}
    union all
    select {id_col}, begin, null, null, null, null, 0 as kind, sentence from {sentences_})
  select {id_col}, begin, "end", result, entity, priority,
         cast(coalesce(last_value(sentence ignore nulls) over (partition by {id_col} order by begin, kind
              rows between unbounded preceding and current row), 0) as integer) as sentence
  from u qualify kind = 1)"""


def tags_from_spans(tokens_: str, spans: str, id_col: str = "doc_id") -> str:
    return f"""(with u as (
    select {id_col}, sentence, pos, begin, "end", result, 1 as kind,
           cast(null as integer) as se, cast(null as varchar) as st from {tokens_}
    union all
    select {id_col}, null, null, begin, null, null, 0 as kind, "end" as se, entity as st from {spans}),
  c as (select *,
    last_value(case when kind = 0 then begin end ignore nulls) over w as sb_,
    last_value(se ignore nulls) over w as se_,
    last_value(st ignore nulls) over w as st_
    from u window w as (partition by {id_col} order by begin, kind rows between unbounded preceding and current row))
  select {id_col}, sentence, pos, begin, "end", result,
    case when se_ is not null and begin <= se_ and begin = sb_ then 'B-' || st_
         when se_ is not null and begin <= se_ then 'I-' || st_ else 'O' end as tag
  from c where kind = 1)"""


def chunks_from_tags(tagged: str, docs: str, id_col: str = "doc_id", text: str = "text") -> str:
    return f"""(with t as (
    select {id_col}, sentence, pos, begin, "end", tag,
      case when tag = 'O' then null else substr(tag, 3) end as typ from {tagged}),
  f as (select *, case when tag like 'B-%' or lag(typ) over w is null or lag(typ) over w <> typ
                        or lag(sentence) over w <> sentence then 1 else 0 end as new_
        from t window w as (partition by {id_col} order by sentence, pos)),
  i as (select *, sum(new_) over (partition by {id_col} order by sentence, pos
                  rows between unbounded preceding and current row) as island from f),
  g as (select {id_col}, island, min(begin) as begin, max("end") as "end", min(typ) as entity,
               min(sentence) as sentence from i where typ is not null group by {id_col}, island)
  select g.{id_col}, cast(g.begin as integer) as begin, cast(g."end" as integer) as "end",
         substr(d.{text}, g.begin + 1, g."end" - g.begin + 1) as result, g.entity,
         cast(g.sentence as integer) as sentence
  from g join {docs} d on g.{id_col} = d.{id_col})"""


def entity_table(chunks: str, id_col: str = "doc_id") -> str:
    return f"""(select cast({id_col} as bigint) as docId, result as entity, entity as entity_type,
         cast(sentence as integer) as sentence_num, cast(begin as integer) as start_pos,
         concat_ws('-', cast({id_col} as varchar), coalesce(entity, 'UNK'), cast(begin as varchar)) as id
  from {chunks})"""


def entity_pivot(table: str, values) -> str:
    cols = ",\n  ".join(
        f"coalesce(string_agg(entity, ', ' order by entity) filter (where entity_type = '{v}'), '') as \"{v}\""
        for v in values)
    return f"(select docId,\n  {cols}\n from {table} group by docId)"


def keywords(tokens_: str, id_col: str = "doc_id", min_n: int = 1, max_n: int = 3, k: int | None = 10,
             threshold: float | None = 0.6, window: int = 1) -> str:
    """Keyword rows (id, keyword, n, score) in DuckDB: term statistics by
    GROUP BY + join (the Spark side uses windows); same formulas."""
    from docweave.operators.keywords import STOPWORDS
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOPWORDS)))
    leads = ", ".join(
        f"lead(term, {j}) over ws as t{j}, lead(s, {j}) over ws as s{j}, "
        f"lead(pos, {j}) over ws as p{j}, lead(stop, {j}) over ws as x{j}" for j in range(1, max_n))
    cands = []
    for n in range(min_n, max_n + 1):
        ok = " and ".join(["not stop"] + [f"p{j} = pos + {j}" for j in range(1, n)]
                          + ([f"not x{n - 1}"] if n > 1 else []))
        kw = " || ' ' || ".join(["term"] + [f"t{j}" for j in range(1, n)])
        prod = " * ".join(["s"] + [f"s{j}" for j in range(1, n)])
        tot = " + ".join(["s"] + [f"s{j}" for j in range(1, n)])
        cands.append(f"select {id_col}, {kw} as keyword, {n} as n, {prod} as prod, {tot} as tot from g where {ok}")
    cand_sql = " union all ".join(cands)
    if window == 1:
        ctx_sql = ("case when lag(word) over ws then lag(term) over ws end as lft,\n"
                   "    case when lead(word) over ws then lead(term) over ws end as rgt,")
        ctx_agg = "count(distinct lft) as dl_n, count(lft) as dl_c, count(distinct rgt) as dr_n, count(rgt) as dr_c,"
    else:
        def side(fn):
            # the j-th neighbour counts when every token up to it is a word
            items = ", ".join(
                "case when " + " and ".join(f"coalesce({fn}(word, {i}) over ws, false)" for i in range(1, j + 1))
                + f" then {fn}(term, {j}) over ws end" for j in range(1, window + 1))
            return f"list_filter([{items}], lambda x: x is not null)"
        ctx_sql = f"{side('lag')} as lfts,\n    {side('lead')} as rgts,"
        ctx_agg = ("len(list_distinct(flatten(list(lfts)))) as dl_n, sum(len(lfts)) as dl_c, "
                   "len(list_distinct(flatten(list(rgts)))) as dr_n, sum(len(rgts)) as dr_c,")
    filt = f"where score < {threshold}" if threshold is not None else ""
    topk = (f"qualify row_number() over (partition by {id_col} order by round(ln(score), 6), keyword) <= {k}"
            if k is not None else "")
    return f"""(with a as (
    select {id_col}, sentence, pos, result, regexp_matches(result, '\\p{{L}}') as word, lower(result) as term
    from {tokens_}),
  b as (select *,
    {ctx_sql}
    coalesce(sum(case when word then 1 else 0 end) over (partition by {id_col}, sentence order by pos
             rows between unbounded preceding and 1 preceding), 0) as wb
    from a window ws as (partition by {id_col}, sentence order by pos)),
  w as (select *, term in ({stop}) as stop,
      case when regexp_matches(result, '^\\p{{Lu}}') and wb > 0 then 1 else 0 end as cap,
      case when length(result) > 1 and regexp_matches(result, '^\\p{{Lu}}+$') then 1 else 0 end as acro
    from b where word),
  ts as (select {id_col}, term, count(*) as tf, sum(cap) as tf_cap, sum(acro) as tf_acro,
      count(distinct sentence) as sf, median(cast(sentence as double)) as med,
      {ctx_agg}
      bool_or(stop) as stop
    from w group by {id_col}, term),
  ds as (select {id_col}, avg(tf) filter (where not stop) as tf_mean,
      stddev_pop(tf) filter (where not stop) as tf_std, max(tf) filter (where not stop) as tf_max
    from ts group by {id_col}),
  ns as (select {id_col}, count(distinct sentence) as n_sent from a group by {id_col}),
  r as (select ts.*, 1 + ((case when dl_c > 0 then dl_n / dl_c else 0.0 end)
             + (case when dr_c > 0 then dr_n / dr_c else 0.0 end)) * tf / coalesce(tf_max, tf) as rel,
      greatest(tf_cap, tf_acro) / (1 + ln(tf)) as case_,
      ln(ln(3 + med)) as posf,
      tf / (coalesce(tf_mean, tf) + coalesce(tf_std, 0.0)) as freq,
      sf / n_sent as spread
    from ts join ds using ({id_col}) join ns using ({id_col})),
  sc as (select {id_col}, term, rel * posf / (case_ + freq / rel + spread / rel) as s from r),
  j as (select w.{id_col}, w.sentence, w.pos, w.term, sc.s, w.stop
    from w join sc on w.{id_col} = sc.{id_col} and w.term = sc.term),
  g as (select *, {leads} from j window ws as (partition by {id_col}, sentence order by pos)),
  c as ({cand_sql}),
  kw as (select {id_col}, keyword, min(n) as n, min(prod) / (count(*) * (1 + min(tot))) as score
    from c group by {id_col}, keyword)
  select {id_col}, keyword, cast(n as integer) as n, score from kw {filt} {topk})"""
