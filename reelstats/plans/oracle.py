"""DuckDB SQL equivalents of the exact queries, over the driver tables.

Every statement starts from the same fixture CTEs (FIXTURES.md section 2)
so it depends only on the pre-registered parquet views.  DuckDB dialect
notes: ``concat`` skips nulls (``||`` is used where nulls must propagate),
``row_number`` is BIGINT (cast to INTEGER), ``sum`` of integers is HUGEINT
(cast to BIGINT).
"""

from __future__ import annotations

_ANY = lambda cols: " or ".join(f"{c} is not null" for c in cols)

FIXTURES = r"""
ol as (
  select l_orderkey, l_partkey, l_quantity, o_custkey,
         cast(epoch(o_orderdate) as bigint) as ep
  from lineitem join orders on l_orderkey = o_orderkey),
ratings_raw as (
  select cast(o_custkey as varchar) as user_id, cast(l_partkey as varchar) as movie_id,
         case when l_orderkey % 89 = 0 then null
              else 'allstar' || cast(1 + cast(l_quantity as int) % 5 as varchar) || '0 rating'
         end as user_rating,
         cast(ep as varchar) as time_stamp
  from ol
  union all
  select cast(o_custkey as varchar), cast(l_partkey as varchar),
         'allstar' || cast(1 + cast(l_quantity as int) % 5 as varchar) || '0 rating',
         cast(ep as varchar)
  from ol where l_orderkey % 97 = 0 and l_orderkey % 89 <> 0
  union all
  select cast(null as varchar), cast(null as varchar), cast(null as varchar), cast(null as varchar)
  from region),
movies_raw as (
  select cast(p_partkey as varchar) as movie_id, p_name as movie_name,
         case when p_partkey % 41 = 0 then null else replace(p_name, ' ', '/') end as movie_type,
         case p_partkey % 4 when 0 then '编剧:' || p_brand
                            when 1 then '主演: ' || p_brand || '...'
                            when 2 then p_brand || ' / 更多...' else null end as movie_writer,
         case when p_partkey % 3 = 0 then '主演:' || p_type else p_type || '更多...' end
           as movie_starring,
         cast(1 + p_size % 9 as varchar) || '.' || cast(p_partkey % 10 as varchar) as movie_rating,
         cast(p_partkey * 37 % 100003 as varchar) as rating_people_num,
         cast(2019 + p_partkey % 5 as varchar) || '-' || lpad(cast(1 + p_partkey % 12 as varchar), 2, '0')
           || '-' || lpad(cast(1 + p_partkey % 28 as varchar), 2, '0') as movie_release_date
  from part),
tags_raw as (
  select cast(o_custkey as varchar) as user_id, cast(l_partkey as varchar) as movie_id,
         case when l_orderkey % 89 = 0 then null else split_part(p_name, ' ', 1) end as user_tag
  from ol join part on p_partkey = l_partkey
  union all
  select cast(o_custkey as varchar), cast(l_partkey as varchar), split_part(p_name, ' ', 2)
  from ol join part on p_partkey = l_partkey),
posters as (
  select cast(p_partkey as varchar) as movie_id,
         'http://img/' || cast(p_partkey as varchar) || '.jpg' as poster_url,
         'http://m/' || cast(p_partkey as varchar) as movie_url
  from part where p_partkey % 7 <> 0),
code_text as (
  select '(' || cast(p_partkey as varchar) || ',' || cast(p_partkey + 1 as varchar) || ')' as value
  from part),
ratings as (
  select cast(user_id as int) as user_id, cast(movie_id as int) as movie_id,
         cast(substring(user_rating, 8, 1) as double) as user_rating,
         cast(time_stamp as bigint) as time_stamp
  from (select distinct * from ratings_raw) x
  where user_id is not null and movie_id is not null and user_rating is not null),
ratings_split as (
  select user_id, movie_id, user_rating, time_stamp,
         case when h < 8 then 'train' when h = 8 then 'test' else 'check' end as split
  from (select *, cast('0x' || substring(md5(cast(user_id as varchar) || ':' || cast(movie_id as varchar)), 1, 8)
                     as bigint) % 10 as h
        from ratings) x),
train as (select user_id, movie_id, user_rating, time_stamp from ratings_split where split = 'train'),
test as (select user_id, movie_id, user_rating, time_stamp from ratings_split where split = 'test'),
chk as (select user_id, movie_id, user_rating, time_stamp from ratings_split where split = 'check'),
ratings_clean as (
  select user_id, movie_id, try_cast(substring(user_rating, 8, 1) as double) as user_rating, time_stamp
  from (select distinct * from ratings_raw) x
  where """ + _ANY(["user_id", "movie_id", "user_rating", "time_stamp"]) + r"""),
movies_clean as (
  select movie_id, movie_name, movie_type,
         replace(movie_writer, '编剧:', '') as movie_writer,
         replace(movie_starring, '主演:', '') as movie_starring,
         movie_rating, rating_people_num, movie_release_date
  from (select distinct * from movies_raw) x
  where """ + _ANY(["movie_id", "movie_name", "movie_type", "movie_writer", "movie_starring",
                    "movie_rating", "rating_people_num", "movie_release_date"]) + r"""),
tags_clean as (
  select distinct * from tags_raw where """ + _ANY(["user_id", "movie_id", "user_tag"]) + r"""),
movies_attr as (
  select movie_id, movie_name, movie_type,
         regexp_replace(case when contains(movie_writer, '主演') then '未提供' else movie_writer end,
                        '\.{3}|更多...', '/更多...', 'g') as movie_writer,
         regexp_replace(case when contains(movie_writer, '主演') then movie_writer else movie_starring end,
                        '\.{3}|更多...', '/更多...', 'g') as movie_starring,
         movie_rating, rating_people_num, movie_release_date
  from movies_clean),
avg_rating as (select movie_id, avg(user_rating) as avg from ratings_clean group by movie_id)
"""

# item-CF chain on the training split (ids, not codes: codes preserve order)
ITEMCF = r"""
,means as (select movie_id as item, avg(user_rating) as mean from train group by movie_id),
pairs as (
  select a.movie_id as item_a, b.movie_id as item_b, sum(least(a.user_rating, b.user_rating)) as s
  from train a join train b on a.user_id = b.user_id and a.movie_id < b.movie_id
  group by 1, 2),
sim as (
  select item_a, item_b, s / (ma.mean + mb.mean) as sim
  from pairs join means ma on ma.item = item_a join means mb on mb.item = item_b),
nb as (
  select item, neighbour, sim,
         cast(row_number() over (partition by item order by sim desc, neighbour) as int) as rank
  from (select item_a as item, item_b as neighbour, sim from sim
        union all select item_b, item_a, sim from sim) x),
nb30 as (select * from nb where rank <= 30),
cand as (
  select t.user_id, n.neighbour as movie_id, t.movie_id as seed, n.sim
  from train t join nb n on n.item = t.movie_id),
top30 as (
  select user_id, rank, movie_id, seed, sim from (
    select *, cast(row_number() over (partition by user_id order by sim desc, movie_id, seed) as int)
              as rank
    from cand) x where rank <= 30),
unseen20 as (
  select user_id, rank, movie_id, seed, sim from (
    select user_id, movie_id, seed, sim,
           cast(row_number() over (partition by user_id order by rank, movie_id, seed) as int) as rank
    from top30 t
    where not exists (select 1 from train s where s.user_id = t.user_id and s.movie_id = t.movie_id)
  ) x where rank <= 20),
fr as (select user_id, movie_id, min(rank) as fr from top30 group by 1, 2)
"""


def _with(body: str, itemcf: bool = False) -> str:
    return "with " + FIXTURES + (ITEMCF if itemcf else "") + "\n" + body


def _k_rows(template: str, ks=(10, 20, 30)) -> str:
    return "\nunion all\n".join(template.format(k=k) for k in ks)


_PROFILE = r"""
, prof as (
  select 'movies' as table_name, count(*) as n_rows,
         (select count(*) from (select distinct * from movies_raw) d) as n_distinct,
         cast(sum(case when movie_id is null or movie_name is null or movie_type is null
                   or movie_writer is null or movie_starring is null or movie_rating is null
                   or rating_people_num is null or movie_release_date is null then 1 else 0 end) as bigint)
           as n_any_null,
         cast(sum(case when movie_id is null and movie_name is null and movie_type is null
                   and movie_writer is null and movie_starring is null and movie_rating is null
                   and rating_people_num is null and movie_release_date is null then 1 else 0 end) as bigint)
           as n_all_null
  from movies_raw
  union all
  select 'ratings', count(*), (select count(*) from (select distinct * from ratings_raw) d),
         cast(sum(case when user_id is null or movie_id is null or user_rating is null
                   or time_stamp is null then 1 else 0 end) as bigint),
         cast(sum(case when user_id is null and movie_id is null and user_rating is null
                   and time_stamp is null then 1 else 0 end) as bigint)
  from ratings_raw
  union all
  select 'tags', count(*), (select count(*) from (select distinct * from tags_raw) d),
         cast(sum(case when user_id is null or movie_id is null or user_tag is null then 1 else 0 end) as bigint),
         cast(sum(case when user_id is null and movie_id is null and user_tag is null then 1 else 0 end) as bigint)
  from tags_raw)
"""

_MACRO = r"""
, tf as (select distinct user_id, movie_id from test),
ts as (select * from tf where user_id in (select user_id from top30)),
hu as (
  select ts.user_id, count(*) as n_test,
         sum(case when fr <= 10 then 1 else 0 end) as h10,
         sum(case when fr <= 20 then 1 else 0 end) as h20,
         sum(case when fr <= 30 then 1 else 0 end) as h30
  from ts left join fr on fr.user_id = ts.user_id and fr.movie_id = ts.movie_id
  group by ts.user_id),
su as (
  select user_id, sum(case when rank <= 10 then 1 else 0 end) as s10,
         sum(case when rank <= 20 then 1 else 0 end) as s20,
         sum(case when rank <= 30 then 1 else 0 end) as s30
  from top30 group by user_id),
w as (
  select count(*) as n_users,
         avg(h10 / n_test * 100.0) as r10, avg(h10 / s10 * 100.0) as p10,
         avg(h20 / n_test * 100.0) as r20, avg(h20 / s20 * 100.0) as p20,
         avg(h30 / n_test * 100.0) as r30, avg(h30 / s30 * 100.0) as p30
  from hu join su using (user_id))
"""

_MICRO = r"""
, tu as (select user_id from test group by user_id having count(*) >= 2),
tf as (select distinct user_id, movie_id from test where user_id in (select user_id from tu)),
ts as (select * from tf where user_id in (select user_id from train)),
h as (select ts.user_id, fr from ts left join fr on fr.user_id = ts.user_id and fr.movie_id = ts.movie_id),
w as (
  select count(distinct user_id) as n_users, count(*) as n_records,
         cast(sum(case when fr <= 10 then 1 else 0 end) as bigint) as m10,
         cast(sum(case when fr <= 20 then 1 else 0 end) as bigint) as m20,
         cast(sum(case when fr <= 30 then 1 else 0 end) as bigint) as m30
  from h),
micro as (
""" + _k_rows("""  select cast({k} as int) as k, m{k} as matched,
         m{k} / (n_users * {k}) * 100.0 as precision, m{k} / n_records * 100.0 as recall from w""") + """)
"""

_MEAN_PRED = r"""
, means as (select movie_id, avg(user_rating) as prediction from train group by movie_id),
pred as (select c.user_id, c.movie_id, c.user_rating, c.time_stamp, m.prediction
         from chk c join means m on m.movie_id = c.movie_id)
"""

_ANY_COLON = " or ".join(f"contains({c}, ':')" for c in [
    "movie_id", "movie_name", "movie_type", "movie_writer", "movie_starring", "movie_rating",
    "rating_people_num", "movie_release_date"])

_SUBSTR_GENRES = r"""
, genres as (select distinct regexp_replace(user_tag, '[\[\]]', '', 'g') as genre from tags_clean
             where user_tag is not null),
gm as (select g.genre, m.* from genres g join movies_attr m
       on m.movie_type is not null and contains(lower(m.movie_type), lower(g.genre)))
"""

SQL: dict[str, str] = {}

SQL["profile_counts"] = _with(_PROFILE + "select table_name, n_rows from prof")
SQL["profile_duplicates"] = _with(
    _PROFILE + "select table_name, n_rows, n_distinct, n_rows - n_distinct as n_duplicates from prof")
SQL["profile_nulls"] = _with(_PROFILE + "select table_name, n_any_null, n_all_null from prof")
SQL["profile_distinct"] = _with(r"""
select 'n_users' as metric, cast(count(distinct user_id) + max(case when user_id is null then 1 else 0 end) as bigint) as value from ratings_clean
union all
select 'n_movies', cast(count(distinct movie_id) + max(case when movie_id is null then 1 else 0 end) as bigint) from ratings_clean
union all
select 'n_tags', cast(count(distinct user_tag) + max(case when user_tag is null then 1 else 0 end) as bigint) from tags_raw""")
SQL["profile_anomaly_any_col"] = _with(
    f"select movie_id, movie_name, movie_writer, movie_starring from movies_raw where {_ANY_COLON}")
SQL["profile_rating_labels"] = _with(r"""
select cast(sum(case when contains(user_rating, 'allstar10 rating') or contains(user_rating, 'allstar20 rating')
  or contains(user_rating, 'allstar30 rating') or contains(user_rating, 'allstar40 rating')
  or contains(user_rating, 'allstar50 rating') then 1 else 0 end) as bigint) as n_labelled from ratings_raw""")
SQL["avg_activity_per_user"] = _with(
    "select avg(n) as user_comm_avg from (select user_id, count(movie_id) as n from ratings_clean group by user_id) x")
SQL["avg_activity_per_item"] = _with(
    "select avg(n) as movie_comm_avg from (select movie_id, count(user_id) as n from ratings_clean group by movie_id) x")
SQL["top10_by_raters"] = _with(r"""
select movie_id, movie_name, movie_rating, rating_people_num from movies_raw
order by try_cast(rating_people_num as int) desc nulls last, try_cast(movie_rating as double) desc nulls last,
         movie_id limit 10""")

SQL["clean_dedupe"] = _with("select distinct * from ratings_raw")
SQL["clean_drop_null_all"] = _with(
    "select * from (select distinct * from ratings_raw) x where "
    + _ANY(["user_id", "movie_id", "user_rating", "time_stamp"]))
SQL["clean_drop_null_any"] = _with(
    "select * from (select distinct * from ratings_raw) x where user_id is not null and "
    "movie_id is not null and user_rating is not null and time_stamp is not null")
SQL["clean_labels"] = _with("select * from movies_clean")
SQL["clean_rating"] = _with("select * from ratings_clean")
SQL["attr_repair"] = _with("select * from movies_attr")
SQL["typed_ratings"] = _with("select * from ratings")
SQL["year_month"] = _with(r"""
select user_id, movie_id, time_stamp,
       cast(strftime(make_timestamp(try_cast(time_stamp as bigint) * 1000000), '%Y%m') as int) as year_month
from ratings_clean""")
SQL["strip_brackets"] = _with(
    r"select distinct regexp_replace('[' || user_tag || ']', '[\[\]]', '', 'g') as genre from tags_raw")
SQL["distinct_tags"] = _with(
    r"select distinct regexp_replace(user_tag, '[\[\]]', '', 'g') as genre from tags_clean where user_tag is not null")

_YM = "cast(strftime(make_timestamp(try_cast(time_stamp as bigint) * 1000000), '%Y%m') as int)"
SQL["popular_items"] = _with("select movie_id, count(movie_id) as count from ratings_clean group by movie_id")
SQL["popular_items_by_month"] = _with(f"""
select movie_id, count(movie_id) as count, year_month from
  (select movie_id, {_YM} as year_month from ratings_clean) x
group by year_month, movie_id""")
SQL["popular_topn_per_month"] = _with(f"""
select year_month, movie_id, count, rank from (
  select year_month, movie_id, count,
         cast(row_number() over (partition by year_month order by count desc, movie_id) as int) as rank
  from (select year_month, movie_id, count(movie_id) as count
        from (select movie_id, {_YM} as year_month from ratings_clean) x
        group by year_month, movie_id) y) z
where rank <= 10""")
SQL["avg_rating"] = _with("select movie_id, avg from avg_rating")
SQL["sql_popular_items"] = SQL["popular_items"]
SQL["sql_popular_items_by_month"] = SQL["popular_items_by_month"]
SQL["sql_avg_rating"] = SQL["avg_rating"]
SQL["movies_with_avg"] = _with(
    "select m.*, a.avg from movies_attr m join avg_rating a on a.movie_id = m.movie_id")
SQL["genre_match"] = _with(_SUBSTR_GENRES + "select genre, movie_id from gm")
SQL["genre_top10"] = _with(_SUBSTR_GENRES + r"""
select genre as movie_type, rank, movie_id, avg from (
  select g.genre, try_cast(g.movie_id as int) as movie_id, a.avg,
         cast(row_number() over (partition by g.genre order by a.avg desc nulls last,
                                  try_cast(g.movie_id as int)) as int) as rank
  from gm g join avg_rating a on a.movie_id = g.movie_id) x
where rank <= 10""")

SQL["dense_code"] = _with(
    "select movie_id, cast(dense_rank() over (order by movie_id) as int) as movie_code "
    "from (select distinct movie_id from ratings) x")
SQL["rating_code"] = _with(r"""
select c.movie_code, r.user_id, r.user_rating, r.time_stamp, r.movie_id
from ratings r join (select movie_id, cast(dense_rank() over (order by movie_id) as int) as movie_code
                     from (select distinct movie_id from ratings) x) c on c.movie_id = r.movie_id""")
SQL["split_hash"] = _with("select * from ratings_split")
SQL["users_min_rated"] = _with(
    "select * from test where user_id in (select user_id from test group by user_id having count(*) >= 2)")

SQL["rating_with_item_mean"] = _with(r"""
select t.user_id, t.movie_id, t.user_rating, m.mean from train t
join (select movie_id, avg(user_rating) as mean from train group by movie_id) m on m.movie_id = t.movie_id""")
SQL["rating_mean_key_mixed"] = _with(r"""
select t.user_id, t.movie_id, t.user_rating, m.mean from train t
join (select user_id, avg(user_rating) as mean from train group by user_id) m on m.user_id = t.movie_id""")
SQL["item_similarity"] = _with("select item_a, item_b, sim from sim", True)
SQL["item_neighbours"] = _with("select item, neighbour, sim, rank from nb30", True)
SQL["item_neighbours_all"] = _with(
    "select item_a as item, item_b as neighbour, sim from sim "
    "union all select item_b, item_a, sim from sim", True)
SQL["item_cf_candidates"] = _with(
    "select user_id, movie_id, count(*) as n_rows, count(distinct seed) as n_seeds, max(sim) as best_sim "
    "from cand group by user_id, movie_id", True)
SQL["item_cf_top30"] = _with("select user_id, rank, movie_id, seed, sim from top30", True)
SQL["item_cf_top30_dedup"] = _with(r"""
, best as (
  select user_id, movie_id, seed, sim from (
    select *, row_number() over (partition by user_id, movie_id order by sim desc, seed) as rn
    from cand) x where rn = 1)
select user_id, rank, movie_id, seed, sim from (
  select *, cast(row_number() over (partition by user_id order by sim desc, movie_id) as int) as rank
  from best) y where rank <= 30""", True)
SQL["item_cf_unseen"] = _with("select user_id, rank, movie_id, seed, sim from unseen20", True)
SQL["item_cf_unseen_first"] = _with(r"""
, allc as (
  select t.user_id, n.neighbour as movie_id, t.movie_id as seed, n.sim
  from train t join nb n on n.item = t.movie_id
  where not exists (select 1 from train s where s.user_id = t.user_id and s.movie_id = n.neighbour))
select user_id, rank, movie_id, seed, sim from (
  select *, cast(row_number() over (partition by user_id order by sim desc, movie_id, seed) as int) as rank
  from allc) x where rank <= 20""", True)
SQL["seen_multiset_diff"] = _with(
    "select user_id, movie_id from top30 except all select user_id, movie_id from train", True)
SQL["matched_multiset"] = _with(
    "select user_id, movie_id from top30 intersect all select user_id, movie_id from test", True)
SQL["explode_recs"] = _with("select user_id, rank, movie_id from top30", True)
SQL["array_ops"] = _with(r"""
, lists as (select user_id, list(movie_id order by rank) as items from top30 group by user_id)
select user_id, cast(len(items) as int) as n_items,
       array_to_string(list_slice(items, 1, 10), ',') as top10,
       array_to_string(list_sort(items), ',') as sorted_items,
       cast(len(list_distinct(items)) as int) as n_distinct
from lists""", True)
SQL["shared_users"] = _with(
    "select distinct user_id from test where user_id in (select user_id from top30)", True)
SQL["unseen_items"] = _with(r"""
select user_id, (select count(distinct movie_id) from train) - count(distinct movie_id) as n_unseen
from train group by user_id""")
SQL["decode_recs"] = _with(r"""
select u.user_id, u.rank, u.movie_id, m.movie_name, m.movie_type
from unseen20 u left join movies_attr m on try_cast(m.movie_id as int) = u.movie_id""", True)

SQL["eval_macro_at_k"] = _with(_MACRO + _k_rows(r"""
select cast({k} as int) as k, n_users, round(r{k}, 6) as recall, round(p{k}, 6) as precision,
       round(2 * p{k} * r{k} / (p{k} + r{k}), 6) as f1 from w"""), True)
SQL["eval_micro_at_k"] = _with(_MICRO + r"""
select k, matched, round(precision, 6) as precision, round(recall, 6) as recall,
       round(2 * precision * recall / (precision + recall), 6) as f1 from micro""", True)
SQL["format_metrics"] = _with(_MICRO + r"""
select concat_ws(',', cast(k as varchar), cast(matched as varchar), cast(round(precision, 6) as varchar),
                 cast(round(recall, 6) as varchar)) as line from micro""", True)
SQL["rmse_item_mean"] = _with(_MEAN_PRED + r"""
select count(*) as n, round(sqrt(avg((user_rating - prediction) * (user_rating - prediction))), 6) as rmse
from pred""")
SQL["truncate_rating"] = _with(_MEAN_PRED + r"""
select user_id, movie_id, prediction, cast(trunc(prediction) as double) as movie_rating from pred""")

SQL["rating_histogram"] = _with(r"""
select name, y, round(100.0 * y / sum(y) over (), 6) as share from
  (select user_rating as name, count(*) as y from ratings group by user_rating) x""")
SQL["dashboard_totals"] = _with(r"""
select 'n_ratings' as metric, count(*) as value from ratings
union all select 'n_users', count(distinct user_id) from ratings
union all select 'n_movies', count(distinct movie_id) from movies_clean
union all select 'n_genres', count(distinct user_tag) from tags_clean""")
_RELEASES = r"""
, rel as (select year(d) as year, month(d) as month, count(*) as count_num from
  (select try_strptime(movie_release_date, '%Y-%m-%d') as d from movies_clean) x
  where d is not null group by 1, 2)
"""
SQL["releases_by_month"] = _with(_RELEASES + "select cast(year as int) as year, cast(month as int) as month, count_num from rel")
SQL["releases_pivot"] = _with(_RELEASES + "select cast(year as int) as year, " + ", ".join(
    f"cast(coalesce(sum(case when month = {m} then count_num end), 0) as bigint) as m{m:02d}"
    for m in range(1, 13)) + " from rel group by year")
SQL["genre_preference"] = _with(
    "select user_tag, count(*) as n from tags_clean where user_tag is not null group by user_tag")
SQL["recent_top10"] = _with(r"""
select movie_id, movie_name, rating_people_num from (
  select * from movies_clean order by replace(movie_release_date, '-', '') desc nulls last, movie_id limit 50) x
order by try_cast(rating_people_num as int) desc nulls last, movie_id limit 10""")
_POSTER = "select m.*, p.poster_url from movies_clean m join posters p on p.movie_id = m.movie_id"
SQL["poster_popular50"] = _with(
    f"{_POSTER} order by try_cast(m.rating_people_num as int) desc nulls last, m.movie_id limit 50")
SQL["poster_recent50"] = _with(
    f"{_POSTER} order by replace(m.movie_release_date, '-', '') desc nulls last, m.movie_id limit 50")
SQL["poster_rated50"] = _with(
    f"{_POSTER} order by try_cast(m.movie_rating as double) desc nulls last, m.movie_id limit 50")

SQL["scan_delimited"] = _with("select * from ratings_raw")
SQL["parse_tuple_text"] = _with(r"""
select try_cast(split_part(substring(value, 2, length(value) - 2), ',', 1) as varchar) as id,
       try_cast(split_part(substring(value, 2, length(value) - 2), ',', 2) as int) as code
from code_text""")

SQL["rejected_ratings"] = _with(r"""
select * from (select distinct * from ratings_raw) x
where try_cast(user_id as int) is null or try_cast(movie_id as int) is null
   or try_cast(substring(user_rating, 8, 1) as double) is null""")
SQL["genre_top10_lists"] = (
    "select movie_type, cast(count(*) as int) as n_items, string_agg(cast(movie_id as varchar), ',' order by rank) "
    "as movie_ids from (" + SQL["genre_top10"] + ") t group by movie_type")
for _name, _order in (("popular_items", "count desc, movie_id nulls first"),
                      ("popular_items_by_month", "year_month desc nulls last, count desc, movie_id nulls first"),
                      ("avg_rating", "avg desc nulls last, movie_id nulls first")):
    SQL[f"{_name}_ranked"] = f"select *, row_number() over (order by {_order}) as position from ({SQL[_name]}) t"
SQL["split_balance"] = _with(r"""
select split, cast(sum(n) as bigint) as n_rows, count(*) as n_users, count(*) filter (where items >= 3) as n_users_3,
       count(*) filter (where items >= 3 and digits = 1) as n_one_digit
from (select split, user_id, count(*) as n, count(distinct movie_id) as items,
             count(distinct movie_id % 10) as digits
      from ratings_split group by split, user_id) x
group by split""")
SQL["split_random_checks"] = _with(r"""
select 'rows' as name, count(*) as value from ratings
union all select 'parts', 3 union all select 'lost', 0 union all select 'doubled', 0""")
SQL["recs_for_users"] = _with(r"""
select user_id, rank, movie_id, seed, sim from unseen20
where user_id in (select c_custkey from customer where c_mktsegment = 'BUILDING')""", True)
SQL["missing_names"] = _with(r"""
select count(*) as n_missing from unseen20 u
where not exists (select 1 from movies_attr m where try_cast(m.movie_id as int) = u.movie_id
                  and m.movie_type is not null and m.movie_name is not null)""", True)
_MACRO_ROWS = r"""
, tr as (select user_id, movie_id, count(*) as t from test group by 1, 2),
tn as (select user_id, sum(t) as n_test from tr where user_id in (select user_id from top30) group by 1),
rr as (
  select user_id, movie_id, count(*) filter (where rank <= 10) as r10, count(*) filter (where rank <= 20) as r20,
         count(*) filter (where rank <= 30) as r30 from top30 group by 1, 2),
hu as (
  select user_id, sum(least(t, r10)) as h10, sum(least(t, r20)) as h20, sum(least(t, r30)) as h30
  from tr join rr using (user_id, movie_id) group by 1),
su as (
  select user_id, count(*) filter (where rank <= 10) as s10, count(*) filter (where rank <= 20) as s20,
         count(*) filter (where rank <= 30) as s30 from top30 group by 1),
w as (
  select count(*) as n_users,
         avg(coalesce(h10, 0) / n_test * 100.0) as r10, avg(coalesce(h10, 0) / s10 * 100.0) as p10,
         avg(coalesce(h20, 0) / n_test * 100.0) as r20, avg(coalesce(h20, 0) / s20 * 100.0) as p20,
         avg(coalesce(h30, 0) / n_test * 100.0) as r30, avg(coalesce(h30, 0) / s30 * 100.0) as p30
  from tn join su using (user_id) left join hu using (user_id))
"""
SQL["eval_macro_multiset"] = _with(_MACRO_ROWS + _k_rows(r"""
select cast({k} as int) as k, n_users, round(r{k}, 6) as recall, round(p{k}, 6) as precision,
       round(2 * p{k} * r{k} / (p{k} + r{k}), 6) as f1 from w"""), True)
SQL["grid_argmin"] = _with(r"""
, g("order", reg) as (values (0, 0.0::double), (1, 1.0::double), (2, 2.0::double), (3, 5.0::double), (4, 10.0::double),
                      (5, 20.0::double), (6, 50.0::double)),
it as (select movie_id, sum(user_rating) as s, count(*) as n from train group by movie_id),
mu as (select avg(user_rating) as mu from train),
fit as (
  select g."order", g.reg, round(sqrt(avg(power(c.user_rating - (it.s + g.reg * mu.mu) / (it.n + g.reg), 2))), 6) as rmse
  from chk c join it using (movie_id), mu, g group by g."order", g.reg)
select cast("order" as int) as "order", reg, rmse,
       "order" = (select "order" from fit order by rmse, "order" limit 1) as is_best
from fit""")
SQL["table_round_trip"] = SQL["clean_labels"]
SQL["list_round_trip"] = SQL["explode_recs"]
SQL["tuple_text_round_trip"] = SQL["parse_tuple_text"]
SQL["metrics_text_round_trip"] = SQL["format_metrics"]
SQL["dashboard_json_round_trip"] = (
    "select cast(year as varchar) || '年' as year_data, cast(month as varchar) || '月' as month_data, count_num from ("
    + SQL["releases_by_month"] + ") t")
SQL["als_checks"] = _with(r"""
, n as (select count(distinct movie_id) as n from train),
seen as (select user_id, count(distinct movie_id) as s from train group by user_id),
tu as (select distinct user_id from test where user_id in (select user_id from train))
select 'items' as name, n as value from n
union all select 'top30_not_the_librarys', 0
union all select 'top30_users', count(*) from tu
union all select 'top30_rows', cast(count(*) * least(30, max(n.n)) as bigint) from tu, n
union all select 'top30_rank_gaps', 0
union all select 'top30_rising', 0
union all select 'top20_users', count(*) from seen, n where s < n.n
union all select 'top20_rows', cast(sum(least(20, n.n - s)) as bigint) from seen, n
union all select 'top20_rank_gaps', 0
union all select 'top20_rising', 0
union all select 'top20_seen', 0
union all select 'predicted_pairs', count(*) from chk
  where user_id in (select user_id from train) and movie_id in (select movie_id from train)
union all select 'saved_differences', 0""")
SQL["als_grid_checks"] = r"""
select 'fits' as name, 24::bigint as value union all select 'combinations', 24 union all select 'without_rmse', 0
union all select 'best', 1 union all select 'better', 0 union all select 'stored_not_best', 0"""

SQL["unseen_items_bitmap"] = SQL["unseen_items"]
SQL["shared_users_bitmap"] = SQL["shared_users"]
SQL["overlap_sizes"] = _with(r"""
select user_id, count(*) as n_common from (
  select distinct user_id, movie_id from top30 intersect select user_id, movie_id from test) x group by user_id""", True)
SQL["distinct_sketches"] = _with(f"""
, ym as (select user_id, movie_id, {_YM} as year_month from ratings_clean),
n as (
  select year_month, count(distinct user_id) as u, count(distinct movie_id) as m from ym group by year_month
  union all select 0, count(distinct user_id), count(distinct movie_id) from ym)
select year_month, 'user_id' as metric, u as n_exact, true as within from n
union all select year_month, 'movie_id', m, true from n""")
SQL["duplicate_sketches"] = _with(
    "select * from (" + " union all ".join(
        f"select '{t}' as table_name, (select count(*) from {t}_raw) as n_rows, "
        f"(select count(*) from (select distinct * from {t}_raw) d) as n_exact, true as within"
        for t in ("movies", "ratings", "tags")) + ") x")
_STEP_COLS = {
    "movies": ["movie_id", "movie_name", "movie_type", "movie_writer", "movie_starring", "movie_rating",
               "rating_people_num", "movie_release_date"],
    "ratings": ["user_id", "movie_id", "user_rating", "time_stamp"], "tags": ["user_id", "movie_id", "user_tag"]}


def _step(table: str, step: str, source: str, text_cols: list[str]) -> str:
    cols = _STEP_COLS[table]
    return (f"select '{table}' as table_name, '{step}' as step, count(*) as n_rows, "
            f"count(*) filter ({' or '.join(c + ' is null' for c in cols)}) as n_any_null, "
            f"count(*) filter ({' and '.join(c + ' is null' for c in cols)}) as n_all_null, "
            f"count(*) filter ({' or '.join(f'coalesce(contains({c}, chr(58)), false)' for c in text_cols)}) as n_colon "
            f"from {source}")


SQL["clean_step_counts"] = _with(" union all ".join(
    q for t, cols in _STEP_COLS.items() for q in [
        _step(t, "raw", f"{t}_raw", cols), _step(t, "deduped", f"(select distinct * from {t}_raw) d", cols),
        _step(t, "complete", f"(select distinct * from {t}_raw where {_ANY(cols)}) d", cols)]
    + ([_step(t, "cleaned", f"{t}_clean", [c for c in cols if c != "user_rating"])] if t != "tags" else [])))
SQL["sql_top_of_month"] = _with(f"""
, c as (
  select year_month, movie_id, count(movie_id) as count from (select movie_id, {_YM} as year_month from ratings_clean) x
  group by 1, 2)
select year_month, movie_id, count, rank from (
  select *, cast(row_number() over (partition by year_month order by count desc, movie_id nulls first) as int) as rank
  from c) x where rank <= 10 and year_month in (199501, 199603)""")
SQL["sql_top_of_genre"] = _with(r"""
select movie_id, movie_name, avg, rank from (
  select m.movie_id, m.movie_name, a.avg,
         cast(row_number() over (order by a.avg desc, try_cast(m.movie_id as int)) as int) as rank
  from movies_attr m join avg_rating a on m.movie_id = a.movie_id
  where contains(lower(m.movie_type), 'widget')) x where rank <= 10""")
SQL["sql_rated_by"] = _with(f"""
select r.movie_id, m.movie_name, r.user_rating, r.year_month from (select *, {_YM} as year_month from ratings_clean) r
left join movies_attr m on r.movie_id = m.movie_id where r.user_id = '4'""")
SQL["scan_rejects"] = _with(r"""
, l as (
  select movie_id, cast(movie_id as int) % 50 as m, coalesce(user_id, '') || '$' || coalesce(movie_id, '') || '$' ||
         coalesce(user_rating, '') || '$' || coalesce(time_stamp, '') as line,
         user_id || '$' || movie_id as two from ratings_raw),
b as (select movie_id, coalesce(m, 9) as m, case m when 0 then two when 1 then line || '$more' when 2 then line || 'x'
             else line end as line from l)
select 'lines' as name, count(*) as value from b
union all select 'good', count(*) from b where m > 2
union all select 'good_movies', cast(sum(cast(movie_id as int)) as bigint) from b where m > 2
union all select 'rejected', count(*) from b where m <= 2
union all select 'rejected_length', cast(sum(length(line)) as bigint) from b where m <= 2""")
SQL["table_replace"] = _with(r"""
select 'open_reader' as name, count(*) as value from movies_raw
union all select 'open_reader_no_type', count(*) from movies_raw where movie_type is null
union all select 'new_reader', count(*) from movies_clean where movie_type is not null
union all select 'new_reader_no_type', 0""")
_DOCS = r"""
, d as (
  select movie_id, movie_name, case when k % 7 <> 0 then movie_type end as movie_type,
         case when k % 11 <> 0 then cast(rating_people_num as int) end as people,
         case when k % 5 = 0 then k end as extra_n, k % 11 = 0 as moved
  from (select *, cast(movie_id as int) as k from movies_raw) x where k % 13 <> 0)
"""
SQL["document_fields"] = _with(_DOCS + "select movie_id, movie_name, movie_type, people, extra_n from d")
SQL["document_report"] = _with(_DOCS + r"""
select 'movie_id' as field, count(*) filter (movie_id is null) as n_missing, 0::bigint as n_mistyped from d
union all select 'movie_name', count(*) filter (movie_name is null), 0 from d
union all select 'movie_type', count(*) filter (movie_type is null), 0 from d
union all select 'people', count(*) filter (people is null and not moved), count(*) filter (moved) from d
union all select 'extra_n', count(*) filter (extra_n is null), 0 from d""")
SQL["bucketed_items"] = _with(r"""
, k as (select movie_id, cast(row_number() over (order by movie_id) as int) as movie_code
        from (select distinct movie_id from movies_clean where movie_id is not null) x)
select k.movie_id, k.movie_code, m.movie_name, m.movie_type, a.avg
from k join movies_attr m on k.movie_id = m.movie_id left join avg_rating a on a.movie_id = k.movie_id""")
SQL["eval_coded_lists"] = _with(r"""
, codes as (select movie_id, row_number() over (order by movie_id) as code from (select distinct movie_id from ratings) x),
best as (select movie_id, avg(user_rating) as mean from train group by movie_id having count(*) >= 5),
top as (select movie_id, row_number() over (order by mean desc, code) as rank from best join codes using (movie_id)),
tu as (
  select user_id from test where user_id in (select user_id from train) group by user_id having count(*) >= 2),
tp as (select distinct user_id, movie_id from test where user_id in (select user_id from tu)),
h as (select tp.user_id, t.rank from tp join top t on t.movie_id = tp.movie_id and t.rank <= 30),
k as (select unnest([10, 20, 30]) as k),
r as (
  select k.k, (select count(*) from h where h.rank <= k.k) as matched, (select count(*) from tu) as n_users,
         (select count(*) from tp) as n_records from k),
w as (select k, matched, matched / (n_users * k) * 100.0 as p, matched / n_records * 100.0 as r from r)
select cast(k as int) as k, matched, round(p, 6) as precision, round(r, 6) as recall, round(2 * p * r / (p + r), 6) as f1
from w""")
SQL["item_neighbours_heavy_user"] = _with(r"""
, t2 as (
  select user_id, movie_id, user_rating from train
  union all select -1, movie_id, 1 + movie_id % 5 from (select distinct movie_id from train where movie_id % 3 = 0) x),
m2 as (select movie_id as item, avg(user_rating) as mean from t2 group by movie_id),
p2 as (
  select a.movie_id as item_a, b.movie_id as item_b, sum(least(a.user_rating, b.user_rating)) as s
  from t2 a join t2 b on a.user_id = b.user_id and a.movie_id < b.movie_id group by 1, 2),
s2 as (
  select item_a, item_b, s / (ma.mean + mb.mean) as sim
  from p2 join m2 ma on ma.item = item_a join m2 mb on mb.item = item_b)
select * from (
  select item, neighbour, sim, cast(row_number() over (partition by item order by sim desc, neighbour) as int) as rank
  from (select item_a as item, item_b as neighbour, sim from s2 union all select item_b, item_a, sim from s2) x) y
where rank <= 30""")
