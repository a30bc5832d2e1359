"""Samples with the columns of their site and of the site's program."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.heavy import KEY, find_heavy, heavy_table, key_hash, usual_tasks

SITE_KEYS = ("SITE_ID", "PROGRAM_ID")
PROGRAM_KEY = "PROGRAM_ID"


def enrich(
    samples: DataFrame,
    sites: DataFrame,
    methods: DataFrame,
    site_keys=SITE_KEYS,
    program_key=PROGRAM_KEY,
    spread: int | None = None,
) -> DataFrame:
    """``samples LEFT JOIN sites LEFT JOIN methods``, methods through the *site's* program.

    A sample without a site therefore has no method either. Methods are joined to the
    sites first, which gives the same rows and moves the large table once, not twice; no
    row with a NULL program then takes part in the second join. Join strategies are left
    to Spark, which broadcasts a side only below its size limit and splits hot keys.

    Spark splits a hot key along the files it comes from, and not at all where a few files hold
    all of it. So where the sites are too large to be broadcast, one pass over the samples' keys
    finds the sites that hold more than two tasks' share of them. Only their samples are dealt out, over
    as many tasks as they would fill four times over, and only these sites are copied as often.
    Samples without a site id, which meet no site, are dealt out the same way. Keys whose type
    differs between the tables are left to Spark.

    With ``spread`` nothing is searched for: samples of every site go over that many tasks, and 1
    says that no site is hot. Spark's estimate does not count the copies that this makes of all sites:
    they are shuffled, not broadcast, where so many times the estimate is above its limit.

    A column that two tables share gets the suffix of the later one (``_METHODE``, ``_SITE``).
    """
    sample_names, method_names, site_names = _names(samples, sites, methods, site_keys, program_key)
    described = sites.withColumnsRenamed(site_names).join(
        methods.withColumnsRenamed(method_names),
        F.col(f"{program_key}_SITE") == F.col(f"{program_key}_METHODE"),
        "left",
    )
    left = samples.withColumnsRenamed(sample_names)
    same_site = [F.col(f"{k}_LTM") == F.col(f"{k}_SITE") for k in site_keys]
    parts = _parts(samples, sites, site_keys, spread)
    if parts:
        left = _shuffled(_dealt(left, [f"{k}_LTM" for k in site_keys], parts, "__part_l"), described, parts)
        described = _copied(described, [f"{k}_SITE" for k in site_keys], parts, "__part_r")
        same_site.append(F.col("__part_l") == F.col("__part_r"))
    joined = left.join(described, same_site, "left")
    return joined.select(*map(_quoted, [*sample_names.values(), *method_names.values(), *site_names.values()]))


def enrich_sql(
    samples: DataFrame,
    sites: DataFrame,
    methods: DataFrame,
    site_keys=SITE_KEYS,
    program_key=PROGRAM_KEY,
    spread: int | None = None,
) -> DataFrame:
    """``enrich`` as SQL text over the three frames, without global view names."""
    columns = ", ".join(
        f"{alias}.`{c}` AS `{name}`"
        for alias, names in zip("smt", _names(samples, sites, methods, site_keys, program_key))
        for c, name in names.items()
    )
    same_site = " AND ".join(f"s.`{k}` = t.`{k}`" for k in site_keys)
    parts = _parts(samples, sites, site_keys, spread)
    if parts:
        samples = _shuffled(_dealt(samples, site_keys, parts, "__part"), sites, parts)
        sites = _copied(sites, site_keys, parts, "__part")
        same_site += " AND s.__part = t.__part"
    return samples.sparkSession.sql(
        f"""
        SELECT {columns}
        FROM {{samples}} AS s
        LEFT JOIN ({{sites}} AS t LEFT JOIN {{methods}} AS m ON t.`{program_key}` = m.`{program_key}`)
          ON {same_site}
        """,
        samples=samples,
        sites=sites,
        methods=methods,
    )


def _parts(samples, sites, site_keys, spread):
    """Over how many tasks the samples of a site go: a number for all, or a number by hash of the site."""
    if spread is not None:
        return spread if spread > 1 else None
    if samples.isStreaming or _broadcastable(sites) or any(
        samples.select(_quoted(k)).schema[0].dataType != sites.select(_quoted(k)).schema[0].dataType for k in site_keys
    ):
        return None
    tasks = usual_tasks(samples.sparkSession)
    found = find_heavy(samples, site_keys, 2 / tasks)
    return found.pieces(found.total / (4 * tasks)) if found.rows else None


def _broadcastable(df, copies=1):
    """Whether Spark, by its own estimate and limit, would send so many copies of the table to every task."""
    state = df.sparkSession._jsparkSession.sessionState()
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return copies * int(str(estimate)) <= state.conf().autoBroadcastJoinThreshold()


def _shuffled(dealt, described, parts):
    """Dealt samples, which keep Spark from sending the copies of ``described`` to every task if they are too large."""
    return dealt.hint("merge") if isinstance(parts, int) and not _broadcastable(described, parts) else dealt


def _dealt(df, keys, parts, name):
    """By the row's own values, so that a task that runs again deals rows out alike."""
    row = F.xxhash64(*map(_quoted, df.columns))
    if isinstance(parts, int):
        return df.withColumn(name, F.pmod(row, F.lit(parts)))
    numbered = df.withColumn("__row", row).withColumn(KEY, key_hash(keys))
    joined = numbered.join(heavy_table(df.sparkSession, parts, "__parts"), KEY, "left")
    return joined.withColumn(name, F.pmod("__row", F.coalesce("__parts", F.lit(1)))).drop(KEY, "__row", "__parts")


def _copied(df, keys, parts, name):
    if isinstance(parts, int):
        return df.withColumn(name, _copies(F.lit(parts)))
    joined = df.withColumn(KEY, key_hash(keys)).join(heavy_table(df.sparkSession, parts, "__parts"), KEY, "left")
    return joined.withColumn(name, _copies(F.coalesce("__parts", F.lit(1)))).drop(KEY, "__parts")


def _copies(number):
    return F.explode(F.sequence(F.lit(0).cast("bigint"), number.cast("bigint") - 1))


def _names(samples, sites, methods, site_keys, program_key):
    """New names of the columns of samples, methods and sites.

    Keys get their table's suffix, and so does a column of methods or sites whose name
    (in any letter case) a table before it has.
    """
    taken, out = set(), []
    for frame, keys, suffix in ((samples, site_keys, "_LTM"), (methods, [program_key], "_METHODE"), (sites, site_keys, "_SITE")):
        names = {}
        for c in frame.columns:
            name = c + suffix if c in keys else c
            while name.lower() in taken:
                name += suffix
            taken.add(name.lower())
            names[c] = name
        out.append(names)
    return out


def _quoted(name):
    return F.col(f"`{name}`")
