"""Order messages as hubs, links and satellites, and counters per user.

All tables come from one row per ordered product (``explode_products``):
order_id, order_dt, cost, payment, status, restaurant_id, restaurant_name,
user_id, user_name, product_id, product_name, category, load_dt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions import uuid3, uuid3_each
from martwright.operators import first_by
from martwright.session import small_tasks

SOURCE = "dds-layer-orders-kafka"
LOGIN = "userlogin"

_NAMED = [T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]
PRODUCT = T.StructType([_NAMED[0], T.StructField("category", T.StringType()), _NAMED[1]])
PAYLOAD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("cost", T.DecimalType(14, 2)),
        T.StructField("payment", T.DecimalType(14, 2)),
        T.StructField("status", T.StringType()),
        T.StructField("restaurant", T.StructType(_NAMED)),
        T.StructField("user", T.StructType(_NAMED)),
        T.StructField("products", T.ArrayType(PRODUCT)),
    ]
)
MESSAGE = T.StructType([T.StructField("object_id", T.StringType()), T.StructField("payload", PAYLOAD)])

# Hub name -> (source column, key column, id column, further columns).
HUBS = {
    "h_restaurant": ("restaurant_id", "h_restaurant_pk", "restaurant_id", ()),
    "h_user": ("user_id", "h_user_pk", "user_id", ()),
    "h_product": ("product_id", "h_product_pk", "product_id", ()),
    "h_category": ("category", "h_category_pk", "category_name", ()),
    "h_order": ("order_id", "h_order_pk", "order_id", ("order_dt",)),
}
# Link name -> (key column, left hub, right hub).
LINKS = {
    "l_order_user": ("hk_order_user_pk", "h_order", "h_user"),
    "l_product_category": ("hk_product_category_pk", "h_product", "h_category"),
    "l_product_restaurant": ("hk_product_restaurant_pk", "h_product", "h_restaurant"),
    "l_order_product": ("hk_order_product_pk", "h_order", "h_product"),
}
# Satellite name -> (key column, hub, source of the hashed value, {output column: source}).
SATELLITES = {
    "s_user_names": ("hk_user_names_pk", "h_user", "user_name", {"username": "user_name"}),
    "s_order_cost": ("hk_order_cost_pk", "h_order", "cost", {"cost": "cost", "payment": "payment"}),
    "s_order_status": ("hk_order_status_pk", "h_order", "status", {"status": "status"}),
    "s_restaurant_names": ("hk_restaurant_names_pk", "h_restaurant", "restaurant_name", {"name": "restaurant_name"}),
    "s_product_names": ("hk_product_names_pk", "h_product", "product_name", {"name": "product_name"}),
}


def explode_products(messages: DataFrame) -> DataFrame:
    """One row per ordered product of each message."""
    p = "payload"
    rows = messages.select(
        F.col(f"{p}.id").alias("order_id"),
        F.col(f"{p}.date").alias("order_dt"),
        F.col(f"{p}.cost").alias("cost"),
        F.col(f"{p}.payment").alias("payment"),
        F.col(f"{p}.status").alias("status"),
        F.col(f"{p}.restaurant.id").alias("restaurant_id"),
        F.col(f"{p}.restaurant.name").alias("restaurant_name"),
        F.col(f"{p}.user.id").alias("user_id"),
        F.col(f"{p}.user.name").alias("user_name"),
        "load_dt",
        F.explode_outer(f"{p}.products").alias("product"),
    )
    return rows.select(
        "*",
        F.col("product.id").alias("product_id"),
        F.col("product.name").alias("product_name"),
        F.col("product.category").alias("category"),
    ).drop("product")


def _pk(hub_name: str) -> Column:
    return uuid3(F.col(HUBS[hub_name][0]).cast("string"))


def hub(rows: DataFrame, name: str) -> DataFrame:
    """A hub: one row per business key with its first load time.

    The natural keys are made unique first; only those are hashed.
    """
    small_tasks(rows.sparkSession)
    source, pk, id_col, extra = HUBS[name]
    kept = rows.where(F.col(source).isNotNull()).groupBy(F.col(source).alias(id_col)).agg(
        *[F.max(c).alias(c) for c in extra], F.min("load_dt").alias("load_dt")
    )
    return kept.select(uuid3(F.col(id_col).cast("string")).alias(pk), id_col, *extra, "load_dt", F.lit(SOURCE).alias("load_src"))


def link(rows: DataFrame, name: str) -> DataFrame:
    """A link: one row per pair of business keys with its first load time."""
    small_tasks(rows.sparkSession)
    pk, left, right = LINKS[name]
    a, b = HUBS[left][0], HUBS[right][0]
    pairs = rows.dropna(subset=[a, b]).groupBy(a, b).agg(F.min("load_dt").alias("load_dt"))
    keyed = pairs.select(_pk(left).alias(HUBS[left][1]), _pk(right).alias(HUBS[right][1]), "load_dt")
    key = uuid3(F.concat(HUBS[left][1], HUBS[right][1])).alias(pk)
    return keyed.select(key, HUBS[left][1], HUBS[right][1], "load_dt", F.lit(SOURCE).alias("load_src"))


def satellite(rows: DataFrame, name: str) -> DataFrame:
    """A satellite: one row per hub key and hashed attribute, the latest one."""
    small_tasks(rows.sparkSession)
    pk, hub_name, hashed, attrs = SATELLITES[name]
    source, hub_pk = HUBS[hub_name][0], HUBS[hub_name][1]
    columns = list(dict.fromkeys([source, hashed, *attrs.values()]))
    distinct = rows.dropna(subset=[source, hashed]).groupBy(*columns).agg(F.max("load_dt").alias("load_dt"))
    others = [c for c in columns if c not in (source, hashed)]
    if others:
        order = [F.col("load_dt").desc(), *[F.col(c).desc_nulls_last() for c in others]]
        distinct = first_by(distinct, [source, hashed], order)
    keyed = distinct.withColumn(hub_pk, _pk(hub_name))
    extra = [F.lit(LOGIN).alias("userlogin")] if name == "s_user_names" else []
    return keyed.select(
        uuid3(F.concat(F.col(hub_pk), F.col(hashed).cast("string"))).alias(pk),
        hub_pk,
        *[F.col(src).alias(out) for out, src in attrs.items()],
        *extra,
        "load_dt",
        F.lit(SOURCE).alias("load_src"),
    )


def vault_tables(rows: DataFrame, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """All hubs, links and satellites by name."""
    builders = {
        **{n: hub for n in HUBS},
        **{n: link for n in LINKS},
        **{n: satellite for n in SATELLITES},
    }
    return {n: build(rows, n) for n, build in builders.items() if names is None or n in names}


# Columns of ``vault_rows``: the own key column of links and satellites is ``key``.
VAULT_COLUMNS = {
    **dict.fromkeys(["vault_table", "key", *(h[1] for h in HUBS.values()), *(h[2] for h in HUBS.values()), "username", "userlogin", "status", "name", "load_src"], "string"),
    **{"cost": "decimal(14,2)", "payment": "decimal(14,2)", "order_dt": "timestamp_ntz", "load_dt": "timestamp_ntz"},
}


def vault_rows(messages: DataFrame) -> DataFrame:
    """Rows of all 14 tables from order messages, by one pass and one shuffle.

    A message gives an entry (table, first and second natural key or hashed value)
    for each table of the order, and each of its products one for each table of the
    product. Equal entries are combined before the shuffle; only what is left is hashed.
    """
    field = {
        "order_id": "id", "cost": "cost", "payment": "payment", "status": "status", "restaurant_id": "restaurant.id",
        "restaurant_name": "restaurant.name", "user_id": "user.id", "user_name": "user.name",
    }
    columns = {name: F.col(f"payload.{path}") for name, path in field.items()}
    columns |= {"product_id": F.col("product.id"), "product_name": F.col("product.name"), "category": F.col("product.category")}
    pairs = {n: (HUBS[n][0], None) for n in HUBS} | {n: (HUBS[a][0], HUBS[b][0]) for n, (_, a, b) in LINKS.items()}
    pairs |= {n: (HUBS[h][0], hashed) for n, (_, h, hashed, _) in SATELLITES.items()}
    of_product = {"product_id", "product_name", "category"}

    def entries(names: list[str]) -> Column:
        def entry(name: str) -> Column:
            a, b = pairs[name]
            return F.struct(
                F.lit(name).alias("vault_table"),
                columns[a].cast("string").alias("a"),
                (columns[b].cast("string") if b else F.lit("")).alias("b"),
                (columns["payment"] if name == "s_order_cost" else F.lit(None).cast("decimal(14,2)")).alias("payment"),
                (F.col("payload.date") if name == "h_order" else F.lit(None).cast("timestamp_ntz")).alias("order_dt"),
            )

        return F.inline(F.array(*map(entry, names)))

    items = [n for n, pair in pairs.items() if of_product & set(pair)]
    heads = messages.select("load_dt", entries([n for n in pairs if n not in items]))
    products = messages.select("load_dt", "payload", F.explode("payload.products").alias("product")).select("load_dt", entries(items))
    # The payment of the last load, the largest of equals, as one number: structs would make Spark sort instead of hash.
    cents = F.lit(10**15).cast("decimal(16,0)")
    stamped = F.unix_micros(F.col("load_dt").cast("timestamp")).cast("decimal(18,0)") * cents + (F.col("payment") * 100).cast("decimal(16,0)")
    grouped = (
        heads.union(products)
        .where("a is not null and b is not null")
        .groupBy("vault_table", "a", "b")
        .agg(
            F.min("load_dt").alias("first_dt"),
            F.max("load_dt").alias("last_dt"),
            F.max("order_dt").alias("order_dt"),
            F.max(F.when(F.col("payment").isNotNull(), stamped)).alias("paid"),
        )
        .withColumn("payment", (F.pmod("paid", cents) / 100).cast("decimal(14,2)"))
    )
    return _laid_out(grouped)


def _laid_out(entries: DataFrame) -> DataFrame:
    """Hash keys and columns of grouped entries."""
    kind = F.substring("vault_table", 1, 1)

    def where(names: list[str], value: Column | str) -> Column:
        return F.when(F.col("vault_table").isin(names), F.col(value) if isinstance(value, str) else value)

    hashed = entries.withColumn("pk_a", uuid3("a")).withColumn("pk_b", F.when(kind == "l", uuid3("b")))
    keyed = hashed.withColumn("key", F.when(kind == "h", F.col("pk_a")).otherwise(uuid3(F.concat("pk_a", F.coalesce("pk_b", "b")))))
    out = {"vault_table": F.col("vault_table"), "key": F.col("key")}
    for hub_name, (_, pk, id_col, _) in HUBS.items():
        firsts = [hub_name, *(n for n, v in LINKS.items() if v[1] == hub_name), *(n for n, v in SATELLITES.items() if v[1] == hub_name)]
        out[pk] = F.coalesce(where(firsts, "pk_a"), where([n for n, v in LINKS.items() if v[2] == hub_name], "pk_b"))
        out[id_col] = where([hub_name], "a")
    out |= {"username": where(["s_user_names"], "b"), "userlogin": where(["s_user_names"], F.lit(LOGIN)), "status": where(["s_order_status"], "b")}
    out |= {"name": where(["s_restaurant_names", "s_product_names"], "b"), "load_src": F.lit(SOURCE)}
    out |= {"cost": where(["s_order_cost"], F.col("b").try_cast("decimal(14,2)")), "payment": F.col("payment"), "order_dt": F.col("order_dt")}
    out["load_dt"] = F.when(kind == "s", F.col("last_dt")).otherwise(F.col("first_dt"))
    return keyed.select(*(column.alias(name) for name, column in out.items()))


def order_message(messages: DataFrame) -> DataFrame:
    """The enriched outgoing message: one row in, one row out, no shuffle."""
    loaded = [F.col("load_dt").alias("load_dt"), F.lit(SOURCE).alias("load_src")]
    products = F.col("payload.products")
    ids = (
        messages.withColumn("r", uuid3(F.col("payload.restaurant.id")))
        .withColumn("u", uuid3(F.col("payload.user.id")))
        .withColumn("o", uuid3(F.col("payload.id")))
        .withColumn("p_pk", uuid3_each(products["id"]))
        .withColumn("c_pk", uuid3_each(products["category"]))
    )

    def joined(left: Column, right: Column) -> Column:
        return uuid3_each(F.zip_with(left, right, lambda a, b: F.concat(a, b)))

    o, u, r = F.col("o"), F.col("u"), F.col("r")
    p_pk, c_pk, names = F.col("p_pk"), F.col("c_pk"), products["name"]
    ids = (
        ids.withColumn("op_pk", uuid3_each(F.transform(p_pk, lambda p: F.concat(o, p))))
        .withColumn("pc_pk", joined(p_pk, c_pk))
        .withColumn("pr_pk", uuid3_each(F.transform(p_pk, lambda p: F.concat(p, r))))
        .withColumn("pn_pk", joined(p_pk, names))
        .withColumn(
            "items",
            F.arrays_zip(
                products["id"].alias("id"),
                names.alias("name"),
                products["category"].alias("category"),
                "p_pk",
                "c_pk",
                "op_pk",
                "pc_pk",
                "pr_pk",
                "pn_pk",
            ),
        )
    )

    def each(**fields: str | Column) -> Column:
        """One struct per product: output name -> item field, or a column of the message."""
        return F.transform(
            "items",
            lambda i: F.struct(
                *[(i[f] if isinstance(f, str) else f).alias(name) for name, f in fields.items()], *loaded
            ),
        )

    def pair(pk: str, a: Column, a_name: str, b: Column, b_name: str) -> list[Column]:
        return [uuid3(F.concat(a, b)).alias(pk), a.alias(a_name), b.alias(b_name)]

    body = F.struct(
        F.struct(r.alias("h_restaurant_pk"), F.col("payload.restaurant.id").alias("restaurant_id"), *loaded).alias("h_restaurant"),
        F.struct(u.alias("h_user_pk"), F.col("payload.user.id").alias("user_id"), *loaded).alias("h_user"),
        each(h_product_pk="p_pk", product_id="id").alias("h_product"),
        each(h_category_pk="c_pk", category_name="category").alias("h_category"),
        F.struct(
            o.alias("h_order_pk"),
            F.col("payload.id").alias("order_id"),
            F.col("payload.date").alias("order_dt"),
            *loaded,
        ).alias("h_order"),
        F.struct(*pair("hk_order_user_pk", o, "h_order_pk", u, "h_user_pk"), *loaded).alias("l_order_user"),
        each(hk_order_product_pk="op_pk", h_order_pk=o, h_product_pk="p_pk").alias("l_order_product"),
        each(hk_product_category_pk="pc_pk", h_product_pk="p_pk", h_category_pk="c_pk").alias("l_product_category"),
        each(hk_product_restaurant_pk="pr_pk", h_product_pk="p_pk", h_restaurant_pk=r).alias("l_product_restaurant"),
        F.struct(
            uuid3(F.concat(u, F.col("payload.user.name"))).alias("hk_user_names_pk"),
            u.alias("h_user_pk"),
            F.col("payload.user.name").alias("username"),
            F.lit(LOGIN).alias("userlogin"),
            *loaded,
        ).alias("s_user_names"),
        F.struct(
            uuid3(F.concat(o, F.col("payload.cost").cast("string"))).alias("hk_order_cost_pk"),
            o.alias("h_order_pk"),
            F.col("payload.cost").alias("cost"),
            F.col("payload.payment").alias("payment"),
            *loaded,
        ).alias("s_order_cost"),
        F.struct(
            uuid3(F.concat(o, F.col("payload.status"))).alias("hk_order_status_pk"),
            o.alias("h_order_pk"),
            F.col("payload.status").alias("status"),
            *loaded,
        ).alias("s_order_status"),
        F.struct(
            uuid3(F.concat(r, F.col("payload.restaurant.name"))).alias("hk_restaurant_names_pk"),
            r.alias("h_restaurant_pk"),
            F.col("payload.restaurant.name").alias("name"),
            *loaded,
        ).alias("s_restaurant_names"),
        each(hk_product_names_pk="pn_pk", h_product_pk="p_pk", name="name").alias("s_product_names"),
    )
    return ids.select("object_id", F.lit("order").alias("object_type"), F.to_json(body).alias("payload"))


# Fields of the enriched message that the counters need.
ENRICHED = T.StructType(
    [
        T.StructField("h_user", T.StructType([T.StructField("h_user_pk", T.StringType())])),
        T.StructField("h_order", T.StructType([T.StructField("h_order_pk", T.StringType())])),
        T.StructField(
            "l_product_category",
            T.ArrayType(
                T.StructType([T.StructField("h_product_pk", T.StringType()), T.StructField("h_category_pk", T.StringType())])
            ),
        ),
        T.StructField(
            "h_category",
            T.ArrayType(
                T.StructType([T.StructField("h_category_pk", T.StringType()), T.StructField("category_name", T.StringType())])
            ),
        ),
        T.StructField(
            "s_product_names",
            T.ArrayType(T.StructType([T.StructField("h_product_pk", T.StringType()), T.StructField("name", T.StringType())])),
        ),
    ]
)


def counter_rows(enriched: DataFrame) -> DataFrame:
    """User, order, product and category of enriched messages, one row per listed product."""
    body = enriched.select(F.from_json("payload", ENRICHED).alias("m"))
    items = F.arrays_zip("m.l_product_category", "m.h_category", "m.s_product_names")
    return body.select(
        F.col("m.h_user.h_user_pk").alias("user_id"),
        F.col("m.h_order.h_order_pk").alias("order_id"),
        F.explode(items).alias("i"),
    ).select(
        "user_id",
        "order_id",
        F.col("i.l_product_category.h_product_pk").alias("product_id"),
        F.col("i.s_product_names.name").alias("product_name"),
        F.col("i.l_product_category.h_category_pk").alias("category_id"),
        F.col("i.h_category.category_name").alias("category_name"),
    )


def natural_counter_rows(rows: DataFrame) -> DataFrame:
    """The same columns straight from exploded products, with hub keys still as natural ids."""
    return rows.select("user_id", "order_id", "product_id", "product_name", F.col("category").alias("category_id"), F.col("category").alias("category_name"))


def _count_orders(rows: DataFrame, thing: str, hashed: bool, unit: str) -> DataFrame:
    small_tasks(rows.sparkSession)
    keys, name = ["user_id", f"{thing}_id"], F.max(f"{thing}_name").alias(f"{thing}_name")
    once = rows.groupBy(*dict.fromkeys([*keys, "order_id", unit])).agg(name)
    counts = once.groupBy(*keys).agg(name, F.count(F.lit(1)).alias("order_cnt"))
    if hashed:
        return counts
    return counts.select(*[uuid3(F.col(k).cast("string")).alias(k) for k in keys], f"{thing}_name", "order_cnt")


def user_product_counters(rows: DataFrame, hashed: bool = False) -> DataFrame:
    """Orders per user and product; a product listed twice in an order counts once.

    ``hashed`` says that the ids are hub keys already; else only the counted
    keys are hashed.
    """
    return _count_orders(rows, "product", hashed, "order_id")


def user_category_counters(rows: DataFrame, hashed: bool = False, per_product: bool = False) -> DataFrame:
    """Orders per user and category, or ordered products per user and category."""
    return _count_orders(rows, "category", hashed, "product_id" if per_product else "order_id")
