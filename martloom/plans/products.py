"""Product feeds and product staging.

Tables, by the names the plans use:
``prod`` master, ``links`` group-to-product, ``groups``, ``group_links`` group-to-group,
``translations``, ``alternates``, ``group_translations``, ``params``, ``replicated_groups``,
``replicated_products``.

A feed first joins the narrow link tables on product *and* country and takes the master rows last.
Staging goes further: feeds, lookups and the pick carry only the master columns they need, and the
rest of the master joins the rows that were chosen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.context import RunContext, audit_stamp
from martloom.functions import dates, text
from martloom.operators.incremental import changed_since
from martloom.operators.lookup import expand_with_parameters, group_parents, lookup
from martloom.operators.pick import bridge_maxima, first_per_key, max_per_key
from martloom.operators.schema import project
from martloom.plans.columns import FEED_LINKS, PRODUCT_MASTER, STAGED_PRODUCT

Tables = Mapping[str, DataFrame]

# Fixed values of the data contract.
STAGING, BRAND, MARKET = "STGH", "BRND", "MKTP"
SAMPLE_TYPES = ("SAMPLE", "EDUCATIONAL")
COMPETITOR = "COMPETITOR"

# The row kept per external id is the first by these columns, nulls first, then by all others; complete rows go first.
INCOMPLETE = "_incomplete"
PICK_ORDER = (
    "sfdc_id_prod_grp",
    "altrnt_id",
    "trnsltd_dsply_nm",
    "trnsltd_prod_desc_txt",
    "start_dt",
    "end_dt",
    "cease_pblsh_dt",
)

ROW_KEY = ["_replicated_id", "product_external_id"]

# Master columns that filters and dates depend on; together they are the key back to the master row.
MASTER_USED = ("prod_typ", "lst_pblsh_dt", "start_dt", "end_dt", "cease_pblsh_dt")
MASTER_KEY = "_master_key"


def _bridge(t: Tables) -> DataFrame:
    return bridge_maxima(t["links"], t["groups"]).select(
        "prod_id",
        "prod_grp_id",
        "grp_prps_cd",
        F.col("end_dt").alias("end_dt_prod_grp_prod"),
        F.col("cease_pblsh_dt").alias("cease_pblsh_dt_prod_grp_prod"),
        F.col("lst_pblsh_dt").alias("link_pblsh_dt"),
    )


def _countries(table: DataFrame, name: str) -> DataFrame:
    return max_per_key(table, ["prod_id", "cntry_cd"], ["lst_pblsh_dt"]).withColumnRenamed("lst_pblsh_dt", name)


def _alternate_and_translated(t: Tables) -> DataFrame:
    """Countries a product has both an alternate id and a translation in, with their last publications."""
    alternates = _countries(t["alternates"], "alternate_pblsh_dt")
    return alternates.join(_countries(t["translations"], "translation_pblsh_dt"), ["prod_id", "cntry_cd"])


PUBLISHED = ("alternate_pblsh_dt", "translation_pblsh_dt", "link_pblsh_dt", "group_translation_pblsh_dt")
FEED = "_feed"


def _with_master(t: Tables, narrow: DataFrame, wanted: Column, since: str) -> DataFrame:
    """Master rows for each link row where they are ``wanted``, if any of the involved rows changed.

    The feed has those master columns that ``prod`` has.
    """
    columns = [c for c in t["prod"].columns if c in (*PRODUCT_MASTER, MASTER_KEY)]
    joined = t["prod"].select(columns).join(narrow, "prod_id").filter(wanted)
    changed = changed_since([F.col("lst_pblsh_dt"), *[F.col(c) for c in PUBLISHED if c in narrow.columns]], since)
    return joined.filter(changed).select([*columns, *FEED_LINKS])


def _of_types(types: Sequence[str]) -> Column:
    return F.col("prod_typ").isin(list(types))


def _linked_to(bridge: DataFrame, master: DataFrame, types: Sequence[str]) -> DataFrame:
    """Bridge rows of products that have a master row of these types."""
    return bridge.join(master.filter(_of_types(types)).select("prod_id"), "prod_id", "left_semi")


def _sample_links(t: Tables, bridge: DataFrame, countries: DataFrame) -> DataFrame:
    brands = bridge.filter(F.col("grp_prps_cd") == BRAND).withColumnRenamed("prod_grp_id", "prod_grp_prnt_id")
    return brands.join(countries, "prod_id")


def sample_feed(t: Tables, since: str, types: Sequence[str] = SAMPLE_TYPES) -> DataFrame:
    """Products linked straight to a brand group, per country with alternate id and translation."""
    return _with_master(t, _sample_links(t, _bridge(t), _alternate_and_translated(t)), _of_types(types), since)


def _parents(t: Tables) -> DataFrame:
    """Market and brand groups above staging groups, with the country of the link."""
    return group_parents(t["group_links"], t["groups"], STAGING, [MARKET, BRAND], with_country=True)


def _to_parent(bridge: DataFrame, parents: DataFrame, with_country: bool) -> DataFrame:
    """Bridge rows of staging groups, moved to the parent group and its purpose."""
    take = {"prod_grp_id_prnt": "prod_grp_prnt_id", "grp_prps_cd": "grp_prps_cd"}
    if with_country:
        take["cntry_cd"] = "cntry_cd"
    narrow = bridge.drop("grp_prps_cd")
    return lookup(narrow, parents, {"prod_grp_id": "prod_grp_id_child"}, take, how="inner").drop("prod_grp_id")


def _market_links(t: Tables, bridge: DataFrame, countries: DataFrame, parents: DataFrame) -> DataFrame:
    markets = parents.filter(F.col("grp_prps_cd") == MARKET)
    return _to_parent(bridge, markets, with_country=True).join(countries, ["prod_id", "cntry_cd"])


def market_feed(t: Tables, since: str, types: Sequence[str]) -> DataFrame:
    """Products by the market group above their staging group, where all three countries agree."""
    return _with_master(t, _market_links(t, _bridge(t), _alternate_and_translated(t), _parents(t)), _of_types(types), since)


def _brand_links(t: Tables, bridge: DataFrame, parents: DataFrame) -> DataFrame:
    brands_above = parents.filter(F.col("grp_prps_cd") == BRAND).drop("cntry_cd").distinct()
    narrow = _to_parent(bridge, brands_above, with_country=False)
    brands = t["groups"].filter(F.col("grp_prps_cd") == BRAND).select("prod_grp_id").distinct()
    translated = max_per_key(
        t["group_translations"].join(brands, "prod_grp_id"),
        ["prod_grp_id", "cntry_cd", "dialect_nm"],
        ["lst_pblsh_dt"],
    )
    narrow = lookup(
        narrow,
        translated,
        {"prod_grp_prnt_id": "prod_grp_id"},
        {"cntry_cd": "cntry_cd", "lst_pblsh_dt": "group_translation_pblsh_dt"},
        how="inner",
    )
    narrow = lookup(
        narrow,
        t["params"],
        {"cntry_cd": "cntry_cd", "grp_prps_cd": "grp_prps_cd"},
        {"dialect_nm": "_dialect"},
        how="inner",
    )
    narrow = lookup(
        narrow,
        t["group_translations"],
        {"prod_grp_prnt_id": "prod_grp_id", "_dialect": "dialect_nm", "cntry_cd": "cntry_cd"},
        {},
        how="inner",
    ).drop("_dialect")
    return narrow.join(_countries(t["translations"], "translation_pblsh_dt"), ["prod_id", "cntry_cd"])


def brand_feed(t: Tables, since: str, types: Sequence[str]) -> DataFrame:
    """Products by the brand group above their staging group, where product and group are
    translated for the same country and the group has the dialect the parameters ask for."""
    return _with_master(t, _brand_links(t, _bridge(t), _parents(t)), _of_types(types), since)


def all_feeds(t: Tables, since: str, types: Sequence[str], sample_types: Sequence[str] = SAMPLE_TYPES) -> DataFrame:
    """The rows of the sample, market and brand feeds together.

    The links of the feeds, of products of their types, are one narrow frame with a mark for the sample feed, and the master
    joins it once: its type is tested against the mark. Bridge, countries and parents are the same plans in each feed.
    """
    bridge, countries, parents = _bridge(t), _alternate_and_translated(t), _parents(t)
    sampled, valued = _linked_to(bridge, t["prod"], sample_types), _linked_to(bridge, t["prod"], types)
    links = [_sample_links(t, sampled, countries), _market_links(t, valued, countries, parents), _brand_links(t, valued, parents)]
    columns = ["prod_id", *FEED_LINKS, *[c for c in PUBLISHED if c not in FEED_LINKS]]
    marked = []
    for number, frame in enumerate(links):
        missing = {c: F.lit(None).cast("date") for c in PUBLISHED if c not in frame.columns}
        marked.append(frame.withColumns({**missing, FEED: F.lit(number == 0)}).select(*columns, FEED))
    wanted = F.when(F.col(FEED), _of_types(sample_types)).otherwise(_of_types(types))
    master = t["prod"].filter(_of_types([*sample_types, *types]))
    return _with_master({**t, "prod": master}, union_feeds(marked), wanted, since)


def touched_products(t: Tables, since: str) -> DataFrame:
    """Ids of all products a feed could have rows of: those with any involved row published since.

    It is a superset of the products the feeds take, found by filters a scan can evaluate.
    """

    def published(name: str, key: str) -> DataFrame:
        return t[name].filter(F.col("lst_pblsh_dt") > F.lit(since).cast("date")).select(F.col(key).alias("prod_id"))

    parents = published("group_translations", "prod_grp_id").distinct()
    children = t["group_links"].join(parents, F.col("prod_grp_id_prnt") == F.col("prod_id"), "left_semi")
    through_groups = t["links"].join(
        children.select("prod_grp_id_child").distinct(), F.col("prod_grp_prnt_id") == F.col("prod_grp_id_child"), "left_semi"
    )
    ids = [
        published("prod", "prod_id"),
        published("links", "prod_child_id"),
        published("alternates", "prod_id"),
        published("translations", "prod_id"),
        through_groups.select(F.col("prod_child_id").alias("prod_id")),
    ]
    return union_feeds(ids).distinct()


PRODUCT_KEYED = {
    "prod": "prod_id",
    "links": "prod_child_id",
    "alternates": "prod_id",
    "translations": "prod_id",
    "replicated_products": "prod_id",
}


def restrict(t: Tables, touched: DataFrame) -> dict[str, DataFrame]:
    """The tables with the rows of the touched products only. All rows of such a product stay, so
    its maxima and lookups do not change."""
    ids = touched.select(F.col("prod_id").alias("_touched"))
    kept = {
        name: t[name].join(ids, F.col(key) == F.col("_touched"), "left_semi") for name, key in PRODUCT_KEYED.items()
    }
    return {**t, **kept}


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    union = feeds[0]
    for feed in feeds[1:]:
        union = union.unionByName(feed)
    return union


def expand_feed(feed: DataFrame, params: DataFrame) -> DataFrame:
    """Feed rows whose purpose and country have parameters, with the parameters."""
    return expand_with_parameters(
        feed,
        params,
        {"grp_prps_cd": "grp_prps_cd", "cntry_cd": "cntry_cd"},
        {
            "dialect_nm": "dialect_nm",
            "altrnt_id_type_cd": "_wanted_type",
            "recordtype": "recordtype",
        },
    )


#: Tables of the feeds and lookups, and the columns that agree with the parameters of their country where a row can match.
PARAMETERED = {
    "translations": ["cntry_cd", "dialect_nm"],
    "alternates": ["cntry_cd", "altrnt_id_type_cd"],
    "group_translations": ["cntry_cd", "dialect_nm"],
    "replicated_groups": ["cntry_cd"],
    "replicated_products": ["cntry_cd"],
}


def with_parameters(t: Tables, names: Sequence[str] = tuple(PARAMETERED), by_country: bool = False) -> dict[str, DataFrame]:
    """The tables with only those rows that rows with parameters can match, by country alone if asked for.

    The parameters are few, so this leaves out rows before they travel. Feeds compare publications over all dialects and
    types of a country, so they are narrowed by country.
    """
    kept = {}
    for name in names:
        columns = ["cntry_cd"] if by_country else PARAMETERED[name]
        wanted = t["params"].select(*[F.col(c).alias(f"_wanted_{c}") for c in columns]).distinct()
        match = reduce(and_, [F.col(c) == F.col(f"_wanted_{c}") for c in columns])
        # With the hint no table is ever dealt by country, which a join by product and country could take over.
        kept[name] = t[name].join(F.broadcast(wanted), match, "left_semi")
    return {**t, **kept}


#: Tables whose country becomes that of a feed row; brands take a group link of any country.
FEED_COUNTRIES = ("translations", "alternates", "group_translations")

LOOKED_UP = """
trnsltd_dsply_nm trnsltd_prod_desc_txt start_dt_trn end_dt_trn cease_pblsh_dt_trn sfdc_id_prod_grp end_dt_pg_trn
cease_pblsh_dt_pg_trn altrnt_id altrnt_id_type_cd__c start_dt_alt end_dt_alt cease_pblsh_dt_alt
""".split()


def add_lookups(feed: DataFrame, t: Tables) -> DataFrame:
    """Translation, replicated group, group translation dates and alternate id of each row.

    Lookups by group come first; then the rows are dealt once, by product, for all that are by product.
    """
    t = with_parameters(t)
    df = lookup(
        feed,
        t["replicated_groups"],
        {"prod_grp_prnt_id": "prod_grp_id", "cntry_cd": "cntry_cd"},
        {"sfdc_id": "sfdc_id_prod_grp"},
    )
    df = lookup(
        df,
        t["group_translations"],
        {"prod_grp_prnt_id": "prod_grp_id", "cntry_cd": "cntry_cd", "dialect_nm": "dialect_nm"},
        {"end_dt": "end_dt_pg_trn", "cease_pblsh_dt": "cease_pblsh_dt_pg_trn"},
    )
    df = lookup(
        df.repartition("prod_id"),
        t["translations"],
        {"prod_id": "prod_id", "cntry_cd": "cntry_cd", "dialect_nm": "dialect_nm"},
        {
            "trnsltd_dsply_nm": "trnsltd_dsply_nm",
            "trnsltd_prod_desc_txt": "trnsltd_prod_desc_txt",
            "start_dt": "start_dt_trn",
            "end_dt": "end_dt_trn",
            "cease_pblsh_dt": "cease_pblsh_dt_trn",
        },
    )
    # The type found replaces the type asked for: a product without alternate id has no type either.
    alternates = t["alternates"].withColumn("_found_type", F.col("altrnt_id_type_cd"))
    df = lookup(
        df,
        alternates,
        {"prod_id": "prod_id", "cntry_cd": "cntry_cd", "_wanted_type": "altrnt_id_type_cd"},
        {
            "altrnt_id": "altrnt_id",
            "_found_type": "altrnt_id_type_cd__c",
            "start_dt": "start_dt_alt",
            "end_dt": "end_dt_alt",
            "cease_pblsh_dt": "cease_pblsh_dt_alt",
        },
    )
    return df.select(*[c for c in feed.columns if c != "_wanted_type"], *LOOKED_UP)


def reconcile_dates(df: DataFrame) -> DataFrame:
    """One start, end and cease date per row from the product's and the looked-up ones.

    The master's far-future cease date counts as open. An open date never limits another one, and
    when all are open the cease date stays the far-future date.
    """
    brand = F.col("grp_prps_cd") == BRAND
    product, translation, link, group, alternate = (
        "cease_pblsh_dt",
        "cease_pblsh_dt_trn",
        "cease_pblsh_dt_prod_grp_prod",
        "cease_pblsh_dt_pg_trn",
        "cease_pblsh_dt_alt",
    )
    cease = {c: dates.open_end(F.col(c)) for c in (translation, link, group, alternate)}
    cease[product] = dates.open_end(dates.close_sentinel(F.col(product)))
    ends = [F.col(c) for c in ("end_dt", "end_dt_trn", "end_dt_prod_grp_prod")]
    return df.withColumns(
        {
            "start_dt": dates.latest([F.col(c) for c in ("start_dt", "start_dt_trn", "start_dt_alt")]),
            "cease_pblsh_dt": dates.earliest_by_purpose(
                brand,
                [cease[c] for c in (product, translation, link, group)],
                [cease[c] for c in (product, translation, alternate, link)],
            ),
            "end_dt": dates.earliest_by_purpose(
                brand, [*ends, F.col("end_dt_pg_trn")], [*ends, F.col("end_dt_alt")]
            ),
        }
    )


def product_external_id() -> Column:
    return text.joined_id(
        [
            F.col("grp_prps_cd"),
            text.id_text(F.col("prod_grp_prnt_id")),
            text.id_text(F.col("prod_id")),
            F.col("cntry_cd"),
            F.col("altrnt_id_type_cd__c"),
        ]
    )


def complete() -> Column:
    """With alternate id, a translated text and a parent id."""
    translated = F.col("trnsltd_dsply_nm").isNotNull() | F.col("trnsltd_prod_desc_txt").isNotNull()
    return F.col("altrnt_id").isNotNull() & translated & F.col("sfdc_id_prod_grp").isNotNull()


def eligible(as_of: Column) -> Column:
    """Already replicated or valid now; and with alternate id, a translated text and a parent id."""
    valid = (F.col("end_dt") >= as_of) & (F.col("cease_pblsh_dt").isNull() | (F.col("cease_pblsh_dt") >= as_of))
    return (F.col("_replicated_id").isNotNull() | valid) & complete()


def candidates(feed: DataFrame, t: Tables, complete_only: bool = False) -> DataFrame:
    """One row per external id, reconciled, with the replicated id where there is one.

    Complete rows are picked before others, so ``complete_only`` leaves out just the external ids without any.
    """
    df = add_lookups(expand_feed(feed, t["params"]), t)
    df = reconcile_dates(df.filter(complete()) if complete_only else df)
    df = df.withColumn("product_external_id", product_external_id())
    staged = [c for c in df.columns if c in STAGED_PRODUCT or c == MASTER_KEY]
    replicated = with_parameters(t)["replicated_products"].select(
        F.col("prod_id").alias("_prod_id"), F.col("cntry_cd").alias("_cntry_cd"), F.col("product_external_id").alias("_replicated_id")
    )
    known = [F.col("prod_id") == F.col("_prod_id"), F.col("cntry_cd") == F.col("_cntry_cd"), F.col("product_external_id") == F.col("_replicated_id")]
    df = df.select(staged).join(replicated, known, "left").drop("_prod_id", "_cntry_cd")
    return first_per_key(df.withColumn(INCOMPLETE, ~complete()), ROW_KEY, (INCOMPLETE, *PICK_ORDER)).drop(INCOMPLETE)


def _with_master_key(master: DataFrame) -> DataFrame:
    return master.withColumn(MASTER_KEY, F.struct(*MASTER_USED))


def narrow_master(master: DataFrame) -> DataFrame:
    """The master columns that decide about a row, and the same once more as the key back to it."""
    return _with_master_key(master).select("prod_id", *MASTER_USED, MASTER_KEY)


def add_master(chosen: DataFrame, master: DataFrame) -> DataFrame:
    """The other master columns of the chosen rows.

    Master rows of one product that agree in everything that decided so far give several rows here;
    the pick goes on over the columns that were added, as if it had seen them in the first place.
    """
    rest = [c for c in PRODUCT_MASTER if c != "prod_id" and c not in chosen.columns]
    found = lookup(
        chosen,
        _with_master_key(master),
        {"prod_id": "prod_id", MASTER_KEY: MASTER_KEY},
        {c: c for c in rest},
        how="inner",
    )
    return first_per_key(found.drop(MASTER_KEY), ROW_KEY, PICK_ORDER)


def product_feed(t: Tables, since: str, own_type: str, run: RunContext) -> DataFrame:
    """Product staging: three feeds, lookups, reconciled dates, one eligible row per external id.

    No duplicate removal follows: rows that share an external id after the pick differ in product
    or country, because only one of them was found among the replicated products.
    """
    types = (COMPETITOR, own_type)
    master = t["prod"].select(PRODUCT_MASTER)
    reached = with_parameters(t, FEED_COUNTRIES, by_country=True)
    narrow = {**reached, "prod": narrow_master(master)}
    chosen = candidates(all_feeds(narrow, since, types), t, complete_only=True).filter(eligible(run.as_of_date))
    wanted = master.filter(F.col("prod_typ").isin([*SAMPLE_TYPES, *types]))
    return audit_stamp(project(add_master(chosen, wanted), STAGED_PRODUCT), run)
