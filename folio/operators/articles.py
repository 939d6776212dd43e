"""The parse stage: pages + fetch metadata + ledger -> articles (E1-E8, J1, J5,
U11, U12, K1, K2, K5, K7, M5).

Shape of the job: one HTML pass (Python, Arrow batches) over ``(page_key, html)``;
the raw HTML column is gone after it, so no shuffle ever carries page bodies.
Everything else is native: JSON fields, defaults, the metadata join (J1), the
duplicate checks (J5, V5), front matter (E6) and cleanup (E7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions import (article_key, clean_markdown, front_matter, strip_ws,
                             url_slug)
from folio.functions.text import DEFAULT_AUTHOR, DEFAULT_DATE, DEFAULT_SOURCE, DEFAULT_TITLE
from folio.operators.html_pass import html_pass
from folio.operators.known import key_filter
from folio.session import html_batches, materialize
from folio.sources.tables import completed_set, scan_fetch_meta
from folio.sources.versioned import VersionedTable

#: Columns of the article store; what a stage lacks (its parts are chosen) is null.
ARTICLES = ("article_key string, page_key string, post_id string, title string, author string, publication_date string, source_url string, "
            "canonical_url string, fetch_timestamp string, body_kind string, n_images int, markdown string, pub_month string, batch_id bigint")


def parsed_pages(pages: DataFrame, parts=("meta", "body", "images"), keys=("page_key", "source_url")) -> DataFrame:
    """HTML pass over S1 rows; keeps ``keys``."""
    return html_pass(pages, list(keys), parts=parts)


def extract_metadata(parsed: DataFrame) -> DataFrame:
    """E1 + O2: article metadata from the raw pass fields (native JSON access)."""
    ld = F.col("ld_json")
    return parsed.select(
        "*",
        F.coalesce(F.get_json_object(ld, "$.headline"), strip_ws(F.col("title_text"))).alias("title"),
        F.coalesce(F.get_json_object(ld, "$.author[0].name"), F.col("meta_author"),
                   F.lit(DEFAULT_AUTHOR)).alias("author"),
        F.coalesce(F.substring(F.get_json_object(ld, "$.datePublished"), 1, 10),
                   F.substring(F.col("meta_published"), 1, 10)).alias("publication_date"),
        F.col("canonical_href").alias("canonical_url"),
        url_slug(F.col("canonical_href")).alias("canonical_slug"),
    )


def _first_per_post(df: DataFrame) -> DataFrame:
    """V5: among rows sharing a post id, the smallest (fetch_ts, source_url,
    page_key) is compiled. Aggregate-then-join (not a window) so a post id shared
    by a third of all pages is combined map-side rather than sorted in one task.
    Rows without a post id, and rows in error, take no part (their join key is null)."""
    firsts = (df.filter(F.col("post_id").isNotNull())
              .groupBy("post_id")
              .agg(F.min(F.struct(F.coalesce("fetch_timestamp", F.lit("")).alias("t"),
                                  F.coalesce("source_url", F.lit("")).alias("u"),
                                  F.col("page_key").alias("k"))).k.alias("first_key"))
              .withColumnRenamed("post_id", "first_post"))
    return df.join(firsts, F.col("post_id") == F.col("first_post"), "left") \
        .withColumn("is_first", F.col("first_key").isNull() | (F.col("first_key") == F.col("page_key"))) \
        .drop("first_key", "first_post")


def _mark_key_owner(p: DataFrame, owners: DataFrame | None = None) -> DataFrame:
    """A page key names one stored page: the first one fetched under it. That is the page
    whose URL ``owners`` (page_key, owner_url: earlier batches) has for the key, else the
    smallest (source_url, content hash, row id) here. ``owns_key`` is false for every other
    page of the key, which is then quarantined. An aggregate joined back, since a key such as
    ``_`` (every home page) may be very frequent."""
    if owners is None:
        p = p.withColumn("may_own", F.lit(True))
    else:
        held = owners.select(F.col("page_key").alias("held_key"), F.coalesce("owner_url", F.lit("")).alias("held_url"))
        p = p.join(held, p.page_key == F.col("held_key"), "left").withColumn(
            "may_own", F.col("held_key").isNull() | (F.col("held_url") == F.coalesce("source_url", F.lit("")))).drop("held_key", "held_url")
    rank = F.struct(F.coalesce("source_url", F.lit("")).alias("u"), F.col("html_hash").alias("h"), F.col("row_id").alias("r"))
    owner = p.filter(F.col("page_key").isNotNull() & F.col("may_own")).groupBy("page_key").agg(F.min(rank).r.alias("owner_id")) \
             .withColumnRenamed("page_key", "owner_key")
    return p.join(owner, p.page_key == F.col("owner_key"), "left") \
            .withColumn("owns_key", F.coalesce(F.col("owner_id") == F.col("row_id"), F.lit(False))).drop("owner_key", "owner_id", "may_own")


def _late_results(parsed: DataFrame, src: DataFrame, done: DataFrame, parts: tuple, results: list[str]) -> DataFrame | None:
    """The wide columns (as ``late_*``, by ``late_row``) of pages that the filter of known ids
    held though the ledger has no such id. They are few, or none and then nothing runs; their
    HTML is found again by its hash, row by row in the pass, so no HTML is shuffled, and they
    meet the narrow columns of deferred pages only, so nothing wide is either."""
    held = parsed.filter("deferred")
    missed = extract_metadata(held).join(done, F.col("canonical_slug") == F.col("done_id"), "left_anti").select(F.col("html_hash").cast("string").alias("h"))
    if missed.isEmpty():
        return None
    again = html_pass(src.withColumn("h", F.col("html_hash").cast("string")), ["source_url", "html_hash", "h"], parts=parts, only=("h", key_filter(missed, "h")))
    again = again.dropDuplicates(["source_url", "html_hash"]).select(F.col("source_url").alias("u"), F.col("html_hash").alias("v"), *(F.col(c).alias(f"late_{c}") for c in results))
    rows = held.select(F.col("row_id").alias("late_row"), "source_url", "html_hash")
    return rows.join(again, rows.source_url.eqNullSafe(F.col("u")) & (rows.html_hash == F.col("v"))).select("late_row", *(f"late_{c}" for c in results))


def parse_stage(pages: DataFrame, meta: DataFrame, completed: DataFrame,
                parts: tuple = ("body", "images"), work_dir: str | None = None,
                owners: DataFrame | None = None) -> DataFrame:
    """Every page of the batch, exactly once, with its article fields and a ``status``:
    ``compiled`` (new article), ``duplicate`` (already complete, or a later copy
    inside the batch: ledger-only), or ``error`` (K7 quarantine, with ``error``).

    ``pages``: S1 rows (page_key, source_url, html); ``meta``: S2 rows;
    ``completed``: the ledger (post_id, seq); ``parts``: which wide results the caller
    reads (``body``: Markdown, ``images``), none for decisions and front matter alone;
    ``work_dir``: where the pass output is written (default: a fresh folder under the
    checkpoint root; a streaming batch passes its own folder so that a replay overwrites it;
    what is compiled late goes beside it, to ``{work_dir}-late``);
    ``owners``: (page_key, owner_url) of pages that own their keys since earlier batches.

    Rows carry a row id of their own: page keys can be null (malformed URL) or shared by
    pages of several hosts, so nothing wide is ever matched by page key.

    A page whose canonical link names a completed article is not compiled: the pass asks a
    filter of the ledger's ids (``known.key_filter``), so its ``body_markdown`` and ``images``
    are null. Pages that the filter held wrongly are compiled in a pass of their own.

    Plan: (1) the HTML pass runs once and is written (``materialize``);
    (2) all decisions — page-key owner, J1 metadata join, defaults, keys, J5 ledger
    join, V5 first-per-post — run on one narrow branch of it (~100 bytes per page; rows in
    error keep a null post id, so they need no branch of their own);
    (3) the wide columns join back once on the unique row id, so the only wide
    shuffle is evenly spread."""
    src = pages.select("page_key", "source_url", "html", F.monotonically_increasing_id().alias("row_id"),
                       F.xxhash64("html").alias("html_hash"))
    done = completed_set(completed).select(F.col("post_id").alias("done_id"), F.lit(True).alias("in_ledger"))
    keys = ["page_key", "source_url", "row_id", "html_hash"]
    known = key_filter(completed, "post_id") if parts else None
    with html_batches(pages.sparkSession):
        parsed = materialize(html_pass(src, keys, parts=("meta", *parts), known=known), "parsed-pages", path=work_dir)
    p = extract_metadata(parsed.select("row_id", "html_hash", "page_key", "source_url", "parse_error", "ld_json", "ld_json_valid",
                                       "title_text", "meta_author", "meta_published", "canonical_href"))
    p = _mark_key_owner(p, owners)
    m = scan_fetch_meta(meta).withColumnRenamed("page_key", "m_key")
    # A page needs its metadata; left join keeps the orphans for quarantine.
    j = p.join(m, p.page_key == m.m_key, "left")
    error = (F.when(F.col("page_key").isNull(), F.lit("malformed url"))
             .when(~F.col("owns_key"), F.lit("duplicate page key"))
             .when(F.col("parse_error").isNotNull(), F.concat(F.lit("parse error: "), F.col("parse_error")))
             .when(~F.col("ld_json_valid"), F.lit("invalid JSON-LD"))
             .when(F.col("m_key").isNull(), F.lit("missing metadata"))
             .when(~F.col("meta_valid"), F.lit("invalid metadata JSON")))
    slug = F.col("canonical_slug")
    j = j.select(
        F.col("row_id"),
        F.col("page_key"),
        F.col("source_url").alias("page_url"),                  # where the page was fetched
        F.coalesce(F.col("title"), F.lit(DEFAULT_TITLE)).alias("title"),
        F.col("author"),
        F.coalesce(F.col("publication_date"), F.lit(DEFAULT_DATE)).alias("publication_date"),
        # Fetch metadata overrides parsed fields
        F.when(F.col("has_source_url"), F.col("meta_source_url"))
         .otherwise(F.lit(DEFAULT_SOURCE)).alias("source_url"),
        F.col("canonical_url"),
        F.col("fetch_timestamp"),
        F.coalesce(F.col("has_fetch_ts"), F.lit(False)).alias("has_fetch_ts"),
        F.when(strip_ws(slug) != "", slug).alias("post_id"),    # V12: "" is no id
        error.alias("error"),
        # without a real source URL the page's own key keeps synthetic keys apart
        F.coalesce(F.when(F.col("has_source_url"), F.col("meta_source_url")), F.col("page_key"),
                   F.col("row_id").cast("string")).alias("identity"),
    ).withColumn("article_key", article_key(F.col("post_id"), F.col("identity"))).drop("identity")
    # Post id already in the ledger -> ledger-only; AQE broadcasts the
    # distinct ledger when it is small and shuffles the narrow side otherwise.
    out = j.withColumnRenamed("post_id", "own_id").withColumn("post_id", F.when(F.col("error").isNull(), F.col("own_id")))
    out = _first_per_post(out.join(done, out.post_id == done.done_id, "left").drop("done_id"))
    status = (F.when(F.col("error").isNotNull(), F.lit("error"))
              .when(F.coalesce(F.col("in_ledger"), F.lit(False)) | ~F.col("is_first"), F.lit("duplicate"))
              .otherwise(F.lit("compiled")))
    out = out.withColumn("status", status).drop("in_ledger", "is_first", "post_id").withColumnRenamed("own_id", "post_id")
    fm = front_matter({
        "title": (F.lit(True), F.col("title")),
        "author": (F.lit(True), F.col("author")),
        "publication-date": (F.lit(True), F.col("publication_date")),
        "source-url": (F.lit(True), F.col("source_url")),
        "canonical-url": (F.lit(True), F.col("canonical_url")),
        "fetch-timestamp": (F.col("has_fetch_ts"), F.col("fetch_timestamp")),
        "post-id": (F.lit(True), F.col("post_id")),
        "article-key": (F.lit(True), F.col("article_key")),
    })
    out = out.withColumn("front_matter", fm)
    if not parts:
        return out
    results = [*(["body_md", "image_errors"] if "body" in parts else []), *(["images"] if "images" in parts else [])]
    wide = parsed.select(F.col("row_id").alias("wide_id"), "n_images", *(["body_kind"] if "body" in parts else []), *results)
    late = _late_results(parsed, src, done, parts, results)
    if late is not None:
        with html_batches(pages.sparkSession):
            late = materialize(late, "late-pages", path=work_dir and f"{work_dir}-late")
        out = out.join(late, F.col("row_id") == F.col("late_row"), "left").drop("late_row")
    out = out.join(wide, F.col("row_id") == F.col("wide_id")).drop("wide_id")
    if late is not None:
        out = out.withColumns({c: F.coalesce(c, f"late_{c}") for c in results}).drop(*(f"late_{c}" for c in results))
    if "images" not in parts:
        out = out.drop("n_images")
    else:
        out = out.withColumn("n_images", F.coalesce("n_images", F.lit(0)))
    if "body" in parts:
        out = out.withColumn("body_markdown", clean_markdown(F.col("body_md"))) \
                 .withColumn("markdown", F.when(F.col("status") == "compiled",
                                                F.concat(F.col("front_matter"), F.col("body_markdown")))).drop("body_md")
    return out


ARTICLE_COLUMNS = ["page_key", "article_key", "post_id", "title", "author", "publication_date",
                   "source_url", "canonical_url", "fetch_timestamp", "status"]


def extract_articles(pages: DataFrame, meta: DataFrame, completed: DataFrame) -> DataFrame:
    """E8 result: the articles of the batch (quarantined pages excluded)."""
    st = parse_stage(pages, meta, completed)
    return st.filter(F.col("status") != "error") \
             .select(*ARTICLE_COLUMNS, "body_kind", "n_images", "markdown")


def image_refs(stage: DataFrame) -> DataFrame:
    """E5 / K5 references: one row per image of a compiled article."""
    return stage.filter(F.col("status") == "compiled") \
        .select("article_key", F.explode("images").alias("im")) \
        .select("article_key", F.col("im.pos").alias("pos"),
                F.col("im.src").alias("image_source_url"), F.col("im.local_path").alias("image_path"),
                F.col("im.alt").alias("alt"), F.col("im.title").alias("title"),
                F.col("im.caption").alias("caption"))


def image_assets(refs: DataFrame) -> DataFrame:
    """K5 assets: one row per stored image path (downloaded once), with bounded
    per-group state: counts and the first referencing article, never a list."""
    return refs.groupBy("image_path").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_refs"),
        F.countDistinct("article_key").cast("bigint").alias("n_articles"),
        F.min("article_key").alias("first_article_key"),
        F.min("image_source_url").alias("first_source_url"))


def quarantine(stage: DataFrame, stage_name: str = "parser") -> DataFrame:
    """K7: failed inputs kept apart with their reason; the batch went on."""
    return stage.filter(F.col("status") == "error").select(
        F.lit(stage_name).alias("stage"), "page_key",
        F.regexp_replace(F.col("error"), r":.*$", "").alias("reason"), F.col("error").alias("detail"))


def ledger_records(stage: DataFrame) -> DataFrame:
    """K2 for a parse batch: every non-error page with a post id appends its id,
    then source->id and canonical->id (non-null URLs only)."""
    rows = stage.filter((F.col("status") != "error") & F.col("post_id").isNotNull())
    return record_completion(rows)


def record_completion(rows: DataFrame) -> DataFrame:
    """K2: (kind, url, post_id) records to append: one ``id`` row, then one
    ``alias`` row per non-null URL."""
    ids = rows.select(F.lit("id").alias("kind"), F.lit(None).cast("string").alias("url"), "post_id")
    urls = rows.select("post_id", F.expr("stack(2, source_url, canonical_url) AS url")) \
        .filter(F.col("url").isNotNull()) \
        .select(F.lit("alias").alias("kind"), "url", "post_id")
    return ids.unionByName(urls)


def articles_table(spark, path: str, buckets: int = 16) -> VersionedTable:
    """K1/M4: the article store, by article key; every write and prune is a new version."""
    return VersionedTable(spark, path, ARTICLES, ["article_key"], buckets)


def store_rows(stage: DataFrame) -> DataFrame:
    """Of a stage what ``write_articles`` stores: the compiled articles, without the columns
    (such as the Markdown once more without its front matter) that the store does not have."""
    names = [f.name for f in T.StructType.fromDDL(ARTICLES)]
    return stage.filter(F.col("status") == "compiled").select("status", *(c for c in stage.columns if c in names))


def write_articles(articles: DataFrame, path: str, batch_id: int = 0, buckets: int = 16) -> None:
    """K1: the compiled articles of one batch, as a new version of the store at ``path``. An
    article key that was written before is replaced; only the buckets of the batch's keys are
    copied. A batch that is in already (a replay) changes nothing."""
    store = articles_table(articles.sparkSession, path, buckets)
    if store.applied(batch_id):
        return
    out = articles.filter(F.col("status") == "compiled").withColumn(
        "pub_month", F.coalesce(F.nullif(F.regexp_extract("publication_date", r"^([0-9]{4}-[0-9]{2})", 1),
                                         F.lit("")), F.lit("unknown"))).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    have = {c.lower() for c in out.columns}
    store.upsert(out.select(*(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in store.schema)), batch_id)


def read_articles(spark, path: str, version: int | None = None) -> DataFrame:
    """K1 read side: the articles of a version (default: the last), one row a key; opens the
    files of that version only."""
    return articles_table(spark, path).read(version)


def prune_articles(spark, path: str, condemned: DataFrame, batch_id: int, buckets: int = 16) -> None:
    """M4 on the store: a new version without the articles of condemned keys (column
    ``article_key``); earlier versions stay readable."""
    store = articles_table(spark, path, buckets)
    if not store.applied(batch_id):
        store.delete(condemned.select("article_key").filter("article_key is not null"), batch_id)


def pages_with_meta(pages: DataFrame, meta: DataFrame) -> DataFrame:
    """J1 on its own: every page with the state of its fetch metadata."""
    m = scan_fetch_meta(meta)
    j = pages.select("page_key").join(m, "page_key", "left")
    return j.select("page_key",
                    F.when(F.col("meta_file").isNull(), F.lit("missing"))
                     .when(~F.col("meta_valid"), F.lit("invalid")).otherwise(F.lit("ok")).alias("meta_status"),
                    "meta_source_url")


def rebuild_ledger(pages: DataFrame, meta: DataFrame) -> DataFrame:
    """M5: completion ledger and alias map recomputed from the source of truth
    (pages + fetch metadata) alone, as distinct (kind, url, post_id) records."""
    empty = pages.sparkSession.createDataFrame([], "post_id string, seq bigint")
    st = parse_stage(pages, meta, empty, parts=())
    return ledger_records(st).distinct()
