"""SQL texts shared by several oracle entries."""

from __future__ import annotations

from collections.abc import Sequence

from ladle.plans.cleaning import _CLEAN_RECIPES_SQL


def features_sql(review_table: str) -> str:
    """CTEs ``clean_recipes`` and ``features`` (Q4) over ``review_table``."""
    return _CLEAN_RECIPES_SQL + f"""
, features as (
  select r.recipeid, r.review_id, r.authorid, r.rating, r.datesubmitted,
         cast(length(r.review) as int) as reviewlength,
         c.name, c.reviewcount, c.calories, c.fatcontent, c.sodiumcontent,
         c.carbohydratecontent, c.proteincontent, c.instructionstep, c.time
  from {review_table} r join clean_recipes c on r.recipeid = c.recipeid)
"""


def unit_vector_sql(name: str, source: str, keys: Sequence[str], cols: Sequence[str],
                    fit_source: str | None = None) -> str:
    """CTE ``name``: keys + ``u0..`` — columns standardised with the mean and
    sample std of ``fit_source`` (0 where the std is 0 or undefined), then
    divided by their L2 norm (a zero vector stays zero)."""
    fit = fit_source or source
    stats = ", ".join(f"avg({c}) as m{i}, stddev_samp({c}) as s{i}" for i, c in enumerate(cols))
    z = ", ".join(
        f"case when st.s{i} is null or st.s{i} = 0 then 0.0 "
        f"else ({c} - st.m{i}) * (1.0 / st.s{i}) end as z{i}" for i, c in enumerate(cols))
    sq = " + ".join(f"z{i} * z{i}" for i in range(len(cols)))
    u = ", ".join(f"case when nrm = 0 then 0.0 else z{i} / nrm end as u{i}"
                  for i in range(len(cols)))
    k = ", ".join(keys)
    return f"""
, {name}_stats as (select {stats} from {fit})
, {name}_z as (select {k}, {z} from {source} cross join {name}_stats st)
, {name}_n as (select *, sqrt({sq}) as nrm from {name}_z)
, {name} as (select {k}, {u} from {name}_n)
"""


def round_cols(prefix: str, n: int, alias: str = "v") -> str:
    return ", ".join(f"round({prefix}{i}, 6) as {alias}{i}" for i in range(n))


def next_recipe_sql(source: str, holdout: bool = False) -> str:
    """CTEs ``freq_rows`` (F5 J3), ``kept`` (W1) and ``seq`` (W2) over ``source``."""
    if holdout:
        seq = """
, seq_all as (
  select *, lead(recipeid) over (partition by authorid order by datesubmitted, review_id) as nextrecipeid,
         row_number() over (partition by authorid order by datesubmitted desc, review_id desc) as rn_desc
  from freq_rows)
, seq as (select * exclude (rn_desc) from seq_all where rn_desc > 1)
"""
    else:
        seq = """
, seq as (
  select * exclude (rn_desc),
         lead(recipeid) over (partition by authorid order by datesubmitted, review_id) as nextrecipeid
  from kept)
"""
    return f"""
, freq_rows as (
  select * from {source}
  where authorid in (select authorid from {source} group by authorid having count(*) > 2))
, kept as (
  select * from (
    select *, row_number() over (partition by authorid
                                 order by datesubmitted desc, review_id desc) as rn_desc
    from freq_rows) t
  where rn_desc > 1)
""" + seq
