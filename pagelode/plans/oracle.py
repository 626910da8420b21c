"""The registered queries as SQL over the given tables.

Written apart from the operators: splits and joins where they use one regular
expression or a literal set, plain subqueries where they use a stored index.
"""

from __future__ import annotations

from functools import cache

from pagelode.functions.words import LANGUAGES, stop_words
from pagelode.plans.fixtures import NOW, SEARCHES, TTL_SECONDS


@cache
def _stop_rows() -> str:
    """VALUES rows (lang, word)."""
    return ", ".join(f"('{lang}', '{word}')" for lang in LANGUAGES for word in stop_words(lang))


def _decoded(x: str) -> str:
    """The entities the given pages hold; the ampersand last, as it builds others."""
    for entity, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        x = f"replace({x}, '&{entity};', '{char}')"
    return x


def _english(w: str) -> str:
    return f"""case when {w} not like '%s' then {w}
      when {w} like '%ies' and not regexp_matches({w}, '(eies|aies)$') then left({w}, length({w}) - 3) || 'y'
      when {w} like '%es' and not regexp_matches({w}, '(aes|ees|oes)$') then left({w}, length({w}) - 1)
      when not regexp_matches({w}, '(us|ss)$') then left({w}, length({w}) - 1)
      else {w} end"""


def _german(w: str) -> str:
    return f"""case when length({w}) < 6 then {w}
      when {w} like '%ern' then left({w}, length({w}) - 3)
      when regexp_matches({w}, 'e[mnrs]$') then left({w}, length({w}) - 2)
      when regexp_matches({w}, '[ens]$') then left({w}, length({w}) - 1)
      else {w} end"""


_HOST = "lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1))"
_TOKENS = r"unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}\p{M}_]+'))"
_IS_WORD = r"regexp_matches(word, '^\p{L}+$')"


def _language(tokens: str) -> str:
    """Language per id of a token CTE with columns (id, word)."""
    return f"""(select id, coalesce(first(lang order by n desc, lang), 'unknown') as language from (
      select t.id, s.lang, count(s.word) as n from {tokens} t left join stops s on s.word = t.word
      group by t.id, s.lang) where lang is not null group by id)"""


# Every name is a common table expression; each may use those before it.
_CTES = {
    "stops": "select * from (values STOP_ROWS) as v(lang, word)",
    "doc": r"""select page_id as link_id, url, html,
        nullif(TITLE, '') as title,
        regexp_replace(TITLE || ' ' || BODY, '[\x00-\x1F\x7F-\x9F]+', ' ', 'g') as text
      from pages""".replace(
        "TITLE", _decoded("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")
    ).replace(
        "BODY",
        _decoded(
            "regexp_replace(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>"
            "|<style[^>]*>.*?</style>|<[^>]*>', ' ', 'g')"
        ),
    ),
    "tok": f"""select id, word from (select link_id as id, {_TOKENS} as word from doc)
      where {_IS_WORD}""",
    "lang": f"""select d.link_id, coalesce(l.language, 'unknown') as language
      from doc d left join {_language('tok')} l on l.id = d.link_id""",
    "content": """select t.id as link_id, l.language, t.word from tok t join lang l on l.link_id = t.id
      where not exists (select 1 from stops s where s.word = t.word
        and s.lang = case when l.language = 'german' then 'german' else 'english' end)""",
    "lemma": f"""select link_id, case when language = 'german' then {_german('word')}
      else {_english('word')} end as word from content""",
    "wr": """select word, link_id, count(*) as weight from lemma group by word, link_id""",
    "link": """select d.link_id, d.url, l.language, d.title from doc d join lang l using (link_id)
      where d.link_id in (select link_id from wr)""",
    "graph": """select distinct p.page_id as link_id_from, t.url as url_to
      from pages p, (select unnest([1, 2, 3, 4, 5]) as j) s, (select count(*) as n from pages) c, pages t
      where t.page_id = (((p.page_id * 31 + s.j * 17) % n) * ((p.page_id * 31 + s.j * 17) % n)) // n""",
    "len": "select link_id, cast(sum(weight) as bigint) as page_length from wr group by link_id",
    "inl": "select url_to as url, count(*) as inlinks from graph group by url_to",
    "stats": """select (select count(*) from wr) as pairs,
        (select max(inlinks) from inl) as max_inlinks""",
    "dict": f"""select distinct word from (select {_TOKENS} as word from documents) where {_IS_WORD}""",
    "typed": """select *, case when url like '%.html' then 'text/html; charset=utf-8'
        when url like '%?%' then null when url like '%#%' then 'application/xhtml+xml'
        else 'text/html' end as content_type from pages""",
    "accepted": "select * from typed where content_type like '%text/html%'",
    "href": f"""select page_id as link_id, url, {_decoded('h')} as href from (
        select page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as h from pages)""",
    "outl": """select link_id, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || href as url_to from href""",
    "timed": """select p.page_id as link_id, p.url, e.indexed_at from pages p left join (
        select user_id, max(ts) as indexed_at from events group by user_id) e on e.user_id = p.page_id""",
    "starts": f"""select min(page_id) as id, arg_min(url, page_id) as url from pages group by {_HOST}""",
    "domains": f"""select {_HOST} as domain, min(page_id) as id
      from pages where html like '%<html lang="de">%' group by 1""",
    "oedge": """select distinct l_orderkey as link_id_from, cast(l_partkey as varchar) as url_to
      from lineitem""",
    "titles": """select link_id, url, title from doc""",
}
_NEEDS = {
    "doc": [],
    "stops": [],
    "tok": ["doc"],
    "lang": ["stops", "tok"],
    "content": ["lang"],
    "lemma": ["content"],
    "wr": ["lemma"],
    "link": ["wr"],
    "graph": [],
    "len": ["wr"],
    "inl": ["graph"],
    "stats": ["wr", "inl"],
    "dict": [],
    "typed": [],
    "accepted": ["typed"],
    "href": [],
    "outl": ["href"],
    "timed": [],
    "starts": [],
    "domains": [],
    "oedge": [],
    "titles": ["doc"],
}


def _with(names: str, body: str, recursive: str = "") -> str:
    wanted: set[str] = set()

    def add(name: str) -> None:
        wanted.add(name)
        for other in _NEEDS[name]:
            if other not in wanted:
                add(other)

    for name in names.split():
        add(name)
    ctes = [f"{name} as ({sql})" for name, sql in _CTES.items() if name in wanted]
    ctes = [cte.replace("STOP_ROWS", _stop_rows()) for cte in ctes]
    if recursive:
        ctes.append(recursive)
    head = "with recursive " if recursive else "with "
    return head + ",\n".join(ctes) + "\n" + body if ctes else body


def _hit(word: str, term: str) -> str:
    return f"(length('{term}') >= 4 and contains({word}, '{term}'))"


def _ranked(where: str, language: str, weight: float, missing: str = "null") -> str:
    """All ranked rows of one query: (title, url, rank, word)."""
    links = "ln(cast(inl.inlinks as double)) / nullif(ln(cast(stats.max_inlinks as double)), 0)"
    if missing == "zero":
        links = f"coalesce({links}, 0.0)"
    return f"""(with sel as (
        select wr.word, wr.link_id, wr.weight, link.url, link.title from wr join link using (link_id)
        where {where} and link.language = '{language}')
      select sel.title, sel.url, sel.word,
        (cast(sel.weight as double) / len.page_length)
          * ln(cast(stats.pairs as double) / (select count(distinct link_id) from sel)) * {weight}
          + (1.0 - {weight}) * ({links}) as rank
      from sel join len using (link_id) left join inl on inl.url = sel.url, stats)"""


_ORDER = "order by rank desc nulls last, url, word"


def _search(where: str, weight: float, limit: int, offset: int = 0) -> str:
    return _with(
        "wr link len inl stats",
        f"""select title, url, word, round(rank, 6) as rank from {_ranked(where, 'english', weight)}
        {_ORDER} limit {limit} offset {offset}""",
    )


_QUERY_FILTER = {
    "+tion -ther": "(contains(word, 'tion') and not contains(word, 'ther'))",
    "": "false",
}


def _where(query: str) -> str:
    return _QUERY_FILTER.get(query) or _hit("word", query)


def _batch() -> str:
    parts = [
        f"""select cast({i} as bigint) as query_id, row_number() over ({_ORDER}) as pos,
        title, url, rank, word from {_ranked(_where(q), lang, w)}"""
        for i, q, lang, w in SEARCHES
    ]
    return _with(
        "wr link len inl stats",
        "select query_id, pos, title, url, word, round(rank, 6) as rank from ("
        + " union all ".join(parts)
        + ") where pos <= 10",
    )


def _suggestions() -> str:
    """(query, term position, term, filter) of the registered suggestion queries."""
    terms = [
        (1, 0, "ther", _hit("word", "ther")),
        (1, 2, "lich", _hit("word", "lich")),
        (2, 0, "keit", _hit("word", "keit")),
        (2, 2, "ther", _hit("word", "ther")),
        (3, 0, "+tion", _hit("word", "tion")),
        (3, 2, "sc*", r"regexp_matches(word, 'sc..')"),
    ]
    parts = [
        f"""select cast({q} as bigint) as query_id, cast({p} as bigint) as term_pos, '{t}' as term,
        row_number() over (order by length(word), word) as pos, word
        from (select distinct word from wr) where {f}"""
        for q, p, t, f in terms
    ]
    return _with("wr", "select * from (" + " union all ".join(parts) + ") where pos <= 6")


def _reachable() -> str:
    return _with(
        "accepted graph domains starts",
        "select link_id, min(level) as level from walk group by link_id",
        recursive=f"""hops as (select g.link_id_from, a.page_id as link_id from graph g
            join accepted a on a.url = g.url_to
            where exists (select 1 from domains d
              where {_HOST.replace('url', 'a.url')} = d.domain
              or {_HOST.replace('url', 'a.url')} like '%.' || d.domain)),
          walk as (
            select a.page_id as link_id, cast(0 as bigint) as level
            from accepted a join starts s on s.url = a.url
            union
            select h.link_id, w.level + 1 from walk w join hops h on h.link_id_from = w.link_id
            where w.level < (select count(*) from accepted))""",
    )


# Stop-word languages of the documents, their grams, and the likeliest language by grams.
_PROFILES = f""", dtok as (select id, word from (select doc_id as id, {_TOKENS} as word from documents)
      where {_IS_WORD}),
    voted as (select d.doc_id, coalesce(l.language, 'unknown') as language
      from documents d left join {_language('dtok')} l on l.id = d.doc_id),
    marked as (select id, '^' || word || '$' as m from dtok),
    dgram as (select id, substr(m, i, 3) as gram from (
      select id, m, unnest(generate_series(1, length(m) - 2)) as i from marked)),
    counts as (select id, gram, count(*) as n from dgram group by id, gram),
    profile as (select gram, language, sum(n) as seen from counts join voted on doc_id = id
      where language <> 'unknown' group by gram, language),
    sizes as (select language, sum(seen) as size, (select count(distinct gram) from profile) as known
      from profile group by language),
    scored as (select c.id, z.language, sum(c.n * ln(coalesce(p.seen, 0) + 1.0) - c.n * ln(z.size + z.known)) as score
      from counts c, sizes z left join profile p on p.gram = c.gram and p.language = z.language
      group by c.id, z.language),
    likeliest as (select id, first(language order by score desc, language) as language from scored group by id)"""


def _learned_lemmas() -> str:
    return _with(
        "tok",
        """, pair as (select distinct a.word as surface, b.word as lemma from tok a join tok b on a.word = b.word || 'ly'),
        told as (select surface, right(surface, size) as ending, 2 as cut, '' as added
          from pair, (select unnest([2, 3, 4, 5]) as size) where size <= length(surface)),
        rule as (select ending from told group by ending having count(*) >= 2),
        asked as (select distinct word from tok)
        select 'english' as lang, word, case when length(word) > 2 and exists (select 1 from rule
            where ending in (right(word, 2), right(word, 3), right(word, 4), right(word, 5)))
          then left(word, length(word) - 2) else word end as lemma from asked""",
    )


def _query_df(columns: str) -> str:
    return _with(
        "wr link",
        f"select {columns} from ("
        + " union all ".join(
            f"""select cast({i} as bigint) as query_id, count(distinct link_id) as pages
            from wr join link using (link_id) where {_where(q)} and language = '{lang}'"""
            for i, q, lang, _ in SEARCHES
        )
        + ") where pages > 0",
    )


def _folded(x: str) -> str:
    return f"replace(replace(replace(strip_accents(lower({x})), 'ß', 'ss'), 'œ', 'oe'), 'æ', 'ae')"


def _search_folded() -> str:
    return _with(
        "wr link graph",
        f""", wf as (select {_folded('word')} as word, link_id, sum(weight) as weight from wr group by 1, 2),
        inl2 as (select lower(url_to) as url, count(distinct link_id_from) as inlinks from graph
          where link_id_from in (select link_id from link) group by 1),
        len2 as (select link_id, sum(weight) as page_length from wr group by link_id),
        sel as (select wf.word, wf.link_id, wf.weight, link.url, link.title from wf join link using (link_id)
          where contains(word, 'schau') and language = 'german')
        select title, sel.url, word, round((cast(weight as double) / page_length)
            * ln((select count(*) from wf) / (select count(distinct link_id) from sel)) * 0.6
          + 0.4 * (ln(cast(inlinks as double)) / nullif(ln((select max(inlinks) from inl2)), 0)), 6) as rank
        from sel join len2 using (link_id) left join inl2 on inl2.url = lower(sel.url)
        {_ORDER} limit 1000""",
    )


def _after_batches() -> str:
    """All ranked rows over pages of which some were indexed again with a word more."""
    return _with(
        "wr link graph outl accepted",
        """, wr2 as (select * from wr union all select 'zzzq', page_id, 1 from accepted),
        edge as (select link_id_from, url_to from graph union select link_id, url_to from outl),
        inl2 as (select url_to as url, count(*) as inlinks from edge
          where link_id_from in (select link_id from link) group by url_to),
        len2 as (select link_id, sum(weight) as page_length from wr2 group by link_id),
        sel as (select wr2.word, wr2.link_id, wr2.weight, link.url, link.title from wr2 join link using (link_id)
          where (contains(word, 'ther') or contains(word, 'zzzq')) and language = 'english')
        select title, sel.url, word, round((cast(weight as double) / page_length)
            * ln((select count(*) from wr2) / (select count(distinct link_id) from sel)) * 0.6
          + 0.4 * (ln(cast(inlinks as double)) / nullif(ln((select max(inlinks) from inl2)), 0)), 6) as rank
        from sel join len2 using (link_id) left join inl2 on inl2.url = sel.url""",
    )


_EPOCH = "epoch_us(indexed_at) // 1000000"
_MATCHED = "select word from dict where "


def oracle_sql() -> dict[str, str]:
    lemma_rule = f"case when c.language = 'german' then {_german('c.word')} else {_english('c.word')} end"
    queries = {
        "page_text": _with("doc", "select link_id, text from doc"),
        "page_title": _with("doc", "select link_id, title from doc"),
        "tokens": _with("tok", "select id as link_id, word from tok"),
        "content_tokens": _with("content", "select link_id, language, word from content"),
        "lemmas": _with(
            "content",
            f"""select word, link_id, count(*) as weight from (
              select c.link_id, coalesce(t.lemma, {lemma_rule}) as word
              from content c left join (
                select distinct a.word as surface, b.word as lemma from tok a join tok b
                on a.word = b.word || 'ly') t
              on t.surface = c.word and c.language <> 'german')
            group by word, link_id""",
        ),
        "detect_language": _with(
            "stops",
            f""", dtok as (select id, word from (select doc_id as id, {_TOKENS} as word from documents)
              where {_IS_WORD})
            select d.doc_id, coalesce(l.language, 'unknown') as language
            from documents d left join {_language('dtok')} l on l.id = d.doc_id""",
        ),
        "detect_language_profiles": _with(
            "stops",
            _PROFILES
            + """ select doc_id, case when v.language <> 'unknown' then v.language
              else coalesce(l.language, 'unknown') end as language from voted v left join likeliest l on l.id = v.doc_id""",
        ),
        "score_language_profiles": _with("stops", _PROFILES + " select id as doc_id, language from likeliest"),
        "learned_lemmas": _learned_lemmas(),
        "term_frequency": _with("wr", "select word, link_id, weight from wr"),
        "page_length": _with("len", "select link_id, page_length from len"),
        "dictionary": _with("wr", "select distinct word from wr"),
        "page_languages": _with("link", "select link_id, language from link"),
        "word_ngrams": _with(
            "dict",
            """select distinct substr(word, i, 4) as gram, word from (
              select word, unnest(generate_series(1, length(word) - 3)) as i from dict
              where length(word) >= 4)""",
        ),
        "match_words": _with("dict", _MATCHED + _hit("word", "ther")),
        "match_words_any": _with(
            "dict", _MATCHED + f"{_hit('word', 'erth')} or {_hit('word', 'lich')}"
        ),
        "match_words_bool": _with(
            "dict", _MATCHED + "contains(word, 'tion') and not contains(word, 'ther')"
        ),
        "match_words_prefix": _with(
            "dict", _MATCHED + "regexp_matches(word, 'sc..') or contains(word, 'keit')"
        ),
        "match_by_ngrams": _with(
            "dict",
            " union all ".join(
                f"select cast({i} as bigint) as query_id, word from dict where {_where(q)}"
                for i, q, _, _ in SEARCHES
            ),
        ),
        "match_words_folded": _with(
            "dict",
            f"""select key, word from (select {_folded('word')} as key, word from dict), (values (1), (2)) v(n)
            where case n when 1 then contains(key, 'cion') and not contains(key, 'mente')
              else contains(key, 'gross') or contains(key, 'chau') end""",
        ),
        "match_by_ngrams_folded": _with(
            "dict",
            f"""select query_id, key, word from (select {_folded('word')} as key, word from dict), ("""
            + " union all ".join(
                f"select cast({i} as bigint) as query_id, k from (select {_folded('word')} as k from dict group by 1) "
                f"where {_where(q).replace('word', 'k')}"
                for i, q, _, _ in SEARCHES
            )
            + ") where k = key",
        ),
        "inlink_count_folded": _with(
            "graph",
            "select lower(url_to) as url_to, count(distinct link_id_from) as inlinks from graph group by 1",
        ),
        "postings_by_word": _with("wr", f"select * from wr where {_hit('word', 'ther')}"),
        "selected_postings": _with(
            "wr link",
            f"""select wr.* from wr join link using (link_id)
            where {_hit('word', 'ther')} and language = 'english'""",
        ),
        "inlink_count": _with("oedge", "select url_to, count(*) as inlinks from oedge group by url_to"),
        "max_inlinks": _with(
            "oedge",
            """select max(n) as max_inlinks from (
              select count(*) as n from oedge group by url_to)""",
        ),
        "backlinks_of_hits": _with(
            "wr link graph",
            f"""select s.link_id, count(distinct g.link_id_from) as inlinks from graph g join (
              select wr.link_id, link.url from wr join link using (link_id)
              where {_hit('word', 'ther')} and language = 'english') s on s.url = g.url_to
            group by s.link_id""",
        ),
        "corpus_stats": _with("stats", "select pairs, max_inlinks from stats"),
        "query_df": _query_df("*"),
        "query_df_sketched": _query_df("query_id, pages, true as close"),
        "search": _search(_hit("word", "ther"), 0.6, 10),
        "search_page2": _search(_hit("word", "ther"), 0.8, 10, 10),
        "search_null_ranks": _search(_hit("word", "erth"), 0.6, 1000),
        "search_collapsed": _with(
            "wr link len inl stats",
            f"""select * from (select any_value(title) as title, url, min(word) as word,
              round(max(rank), 6) as rank
            from {_ranked(_hit('word', 'ther'), 'english', 0.6, 'zero')} group by url)
            {_ORDER} limit 10""",
        ),
        "search_batch": _batch(),
        "search_after_batches": _after_batches(),
        "search_folded": _search_folded(),
        "suggest": _suggestions(),
        "result_anchor": """select url, '<a href="' || url || '">' || url || '</a>' as anchor from pages""",
        "out_links": _with("outl", "select link_id, url_to from outl"),
        "allowed_links": _with(
            "outl domains",
            f"""select link_id, url_to from outl where exists (select 1 from domains d
              where {_HOST.replace('url', 'url_to')} = d.domain
              or {_HOST.replace('url', 'url_to')} like '%.' || d.domain)""",
        ),
        "new_urls": _with(
            "outl graph",
            """select url_to as url from outl union select url_to from graph
            except select url from pages""",
        ),
        "reachable_pages": _reachable(),
        "reach_delta": _reachable(),
        "mime_filter": _with("accepted", "select page_id, content_type from accepted"),
        "index_age": _with(
            "outl graph timed",
            f"""select u.url, {_EPOCH} as indexed_s from (
              select url_to as url from graph union select url_to from outl) u
            left join timed t on t.url = u.url""",
        ),
        "recrawl_due": _with(
            "timed",
            f"""select link_id as page_id, url from timed where indexed_at is null
            or indexed_at <= timestamp '{NOW}' - interval {TTL_SECONDS} second""",
        ),
        "recrawl_gate": f"""with recursive log as (
              select distinct cast(user_id as varchar) as url, epoch_us(ts) as time from events),
            acc as (
              select url, min(time) as time from log group by url
              union all
              select a.url, min(l.time) from acc a join log l
              on l.url = a.url and l.time >= a.time + {TTL_SECONDS * 1_000_000} group by a.url)
            select url, time from acc""",
        "recrawl_throttle": f"""with recursive log as (
              select distinct user_id as url, epoch_us(ts) as time from events),
            acc as (
              select url, min(time) as time from log group by url
              union all
              select a.url, min(l.time) from acc a join log l
              on l.url = a.url and l.time >= a.time + {TTL_SECONDS * 1_000_000} group by a.url)
            select url, time from acc""",
        "touch_indexed": _with(
            "timed accepted",
            f"""select t.link_id, t.url, case when a.page_id is not null
              then epoch_us(timestamp '{NOW}') // 1000000 else {_EPOCH} end as indexed_s
            from timed t left join accepted a on a.page_id = t.link_id""",
        ),
        "resolve_ids": """with asked as (select l_orderkey * 10 + l_linenumber as pos,
              l_partkey as ps_partkey, l_suppkey as ps_suppkey from lineitem)
            select pos, ps_partkey, ps_suppkey,
              min(pos) over (partition by ps_partkey, ps_suppkey) as id from asked""",
        "insert_ignore": _with(
            "graph accepted",
            """select distinct t.page_id as link_id_from, f.url as url_to from graph g
            join accepted t on t.url = g.url_to join pages f on f.page_id = g.link_id_from
            where not exists (select 1 from graph o
              where o.link_id_from = t.page_id and o.url_to = f.url)""",
        ),
        "insert_ignore_max_len": _with(
            "accepted",
            """select left(url, 30) as url, min(page_id) as pos from pages
            where left(url, 30) not in (select left(url, 30) from accepted) group by 1""",
        ),
        "upsert_keep_first": _with(
            "titles accepted",
            """select t.link_id, t.url,
              case when a.page_id is null then '1 ' || t.title else t.title end as title
            from titles t left join accepted a on a.page_id = t.link_id""",
        ),
        "upsert_replace": _with("titles", "select link_id, url, '2 ' || title as title from titles"),
        "delete_by_key": _with(
            "dict tok",
            "select word from dict where length(word) < 10 or word in (select word from tok)",
        ),
        "store_upsert_delete": _with(
            "graph accepted titles timed tok",
            f""", edge0 as (select * from graph where link_id_from in (select page_id from accepted)),
            edge as (select * from edge0 union select t.page_id, f.url from edge0 g
              join accepted t on t.url = g.url_to join pages f on f.page_id = g.link_id_from)
            select 'link' as name, t.link_id as id,
              case when a.page_id is null then '1 ' || t.title else t.title end as value
            from titles t left join accepted a on a.page_id = t.link_id
            where t.link_id % 2 <> 1 or t.link_id in (select link_id_from from edge)
            union all select 'edge', link_id_from, url_to from edge
            union all select 'time', t.link_id, cast(case when a.page_id is not null
                then epoch_us(timestamp '{NOW}') // 1000000 else {_EPOCH} end as varchar)
              from timed t left join accepted a on a.page_id = t.link_id
              where a.page_id is not null or t.indexed_at is not null
            union all select 'word', cast(null as bigint), word from (select distinct word from tok)
              where length(word) < 8 or word in (select word from tok where id in (select page_id from accepted))""",
        ),
        "seed_if_empty": _with(
            "accepted",
            f"""select 'empty' as before, url from pages union all select 'empty', {_HOST} from pages
            union all select 'full', url from accepted""",
        ),
        "scan_start_urls": _with("starts", "select id, url from starts"),
        "scan_allowed_domains": _with("domains", "select id, domain from domains"),
        "valid_start_urls": _with(
            "href",
            """select url from (select href as url from href union all select url from pages)
            where url like 'http://%.%' or url like 'https://%.%'""",
        ),
        "parse_duration": """select l_orderkey, l_linenumber, q || u as duration,
              q * case u when 's' then 1 when 'm' then 60 when 'h' then 3600 when 'd' then 86400
                when 'w' then 604800 when 'M' then 2592000 when 'y' then 31536000 else 0 end as seconds
            from (select l_orderkey, l_linenumber, cast(l_quantity as bigint) as q,
              substr('smhdwMyx', cast(l_linenumber as int) + 1, 1) as u from lineitem)""",
        "index_build": _with(
            "link wr outl accepted",
            """select link.link_id, link.url, language, title, words, page_length, targets
            from link join accepted on page_id = link.link_id
            join (select link_id, count(*) as words, cast(sum(weight) as bigint) as page_length
              from wr group by link_id) w on w.link_id = link.link_id
            left join (select link_id, count(distinct url_to) as targets
              from outl group by link_id) o on o.link_id = link.link_id""",
        ),
        "index_stats": _with(
            "typed link",
            """select case when content_type is null or content_type not like '%text/html%'
                then 'content_type' when link_id is null then 'no_content' else 'indexed' end as outcome,
              count(*) as pages
            from typed left join link on link_id = page_id group by 1""",
        ),
        "stream_index": _with("link", "select link_id, url, language, title from link"),
        "reindex_keep_first": _with(
            "wr accepted",
            "select word, link_id, weight from wr union all select 'zzzq', page_id, 1 from accepted",
        ),
        "reindex_replace": _with(
            "wr accepted",
            """select word, link_id, weight from wr union all select 'zzzq', page_id, 1
            from pages where page_id not in (select page_id from accepted)""",
        ),
        "new_url_runs": _with("outl", "select url_to as url, min(link_id % 3) as run from outl group by url_to"),
        "new_url_stream": _with("outl", "select distinct url_to as url from outl"),
        "fold_words": _with(
            "dict",
            """select min(word) as word, count(*) as variants from dict
            group by replace(replace(replace(strip_accents(word), 'ß', 'ss'), 'œ', 'oe'), 'æ', 'ae')""",
        ),
    }
    return queries
