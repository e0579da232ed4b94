"""A bounded breadth-first crawl: the frontier is a table, a level is a plan.

Only the loop's counters live on the driver.  A level fetches its pages in
parallel, explodes their links, and takes away what is known by anti-joins;
every event (a page read, a link seen) carries its place in first-in-first-out
order, so that "the first title wins" is a minimum and limits keep what a
one-by-one crawl would keep.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions import urls as U
from quarry.functions.text import text_of
from quarry.lineage import cut
from quarry.operators.dedup import counted_ranks, merged

Ask = Callable[[DataFrame], DataFrame]
LINKS_A_PAGE = 1 << 20
SENT = 10_000  # URLs of a level that are broadcast; more are joined by a shuffle.


@dataclass(frozen=True)
class CrawlConfig:
    base_url: str
    max_pages: int = 5
    max_follow_pages: int | None = None
    max_assets: int | None = None

    def __post_init__(self) -> None:
        if self.max_pages <= 0 or any(x is not None and x < 0 for x in (self.max_follow_pages, self.max_assets)):
            raise ValueError("crawl limits must not be negative, and at least one listing page is read")


@dataclass(frozen=True)
class Crawl:
    inventory: DataFrame
    summary: dict[str, int]


def table_web(web: DataFrame) -> Ask:
    """Fetching as a join with a table (url, status, content_type, html); other URLs have no status."""
    held = web.select(F.col("url").alias("_u"), "status", "content_type", "html")

    def ask(urls: DataFrame) -> DataFrame:
        # Few URLs are sent to the table (the crawl marks them), so that only their pages move.
        asked = held.join(urls.select(F.col("url").alias("_u")), "_u", "left_semi")
        return urls.join(asked, F.col("url") == F.col("_u"), "left").select("url", "status", "content_type", "html")

    return ask


def _parsed(pages: DataFrame) -> DataFrame:
    """(visit, url, status, content_type, title, links) of fetched pages; only a page with status 200 has links."""
    return pages.withColumn("page", H.page(F.col("html"))).select("visit", "url", "status", "content_type", F.col("page.title").alias("title"), F.when(F.col("status") == 200, F.col("page.links")).alias("links"))


def _relevant(pages: DataFrame) -> DataFrame:
    """(visit, link_no, url, title, source_url, source_title, kind) of the links worth a row."""
    links = pages.select("visit", F.col("url").alias("source_url"), F.col("title").alias("source_title"), F.posexplode("links").alias("link_no", "link"))
    absolute = links.withColumn("url", U.resolved(F.col("source_url"), F.col("link.href")))
    kept = absolute.filter(F.col("url").isNotNull() & U.is_relevant(F.col("source_url"), F.col("url")))
    return kept.select("visit", "link_no", "url", F.col("link.text").alias("title"), "source_url", "source_title", U.resource_kind(F.col("url")).alias("kind")).filter(F.col("kind") != "other")


def _place(link_no: Column | int = -1) -> Column:
    return F.col("visit") * LINKS_A_PAGE + (link_no if isinstance(link_no, Column) else F.lit(link_no)) + 1


def _within(links: DataFrame, known_assets: DataFrame, room: int | None) -> DataFrame:
    """``links`` without assets beyond the limit: the first ``room`` new ones, in order, stay."""
    if room is None:
        return links
    asset = F.col("kind") == "asset"
    new = links.filter(asset).join(known_assets, "url", "left_anti").groupBy("url").agg(F.min(_place(F.col("link_no"))).alias("at")).orderBy("at").limit(room).select("url")
    allowed = known_assets.unionByName(new)
    return links.filter(~asset).unionByName(links.filter(asset).join(allowed, "url", "left_semi"))


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _assets(links: DataFrame) -> DataFrame:
    return links.filter(F.col("kind") == "asset").select("url").distinct()


def crawl(spark: SparkSession, config: CrawlConfig, fetch: Ask, probe: Ask | None = None, progress: Callable[[str, int], None] | None = None) -> Crawl:
    """``fetch`` gives (url, status, content_type, html) and ``probe`` (url, status, content_type) of (url).

    ``progress`` gets a message and the number of pages read so far.  An unreachable page has no status (or 0) and its state is unknown, as an asset's is.
    """
    probe = probe or (lambda urls: fetch(urls).drop("html"))
    reads: list[DataFrame] = []  # pages with what is known of them, a level each
    found: list[DataFrame] = []  # their links
    assets = [spark.createDataFrame([], "url string")]  # new ones of each level, kept only where they are counted
    levels = [spark.createDataFrame([], "url string")]
    signatures: set[str] = set()
    visit, n_assets = 0, 0

    def gather(fetched: DataFrame, listing: bool) -> DataFrame:
        nonlocal n_assets
        pages = cut(_parsed(fetched))
        room = None if config.max_assets is None else max(0, config.max_assets - n_assets)
        links = cut(_within(_relevant(pages), _all(assets), room))
        if config.max_assets is not None or progress is not None:
            assets.append(cut(_assets(links).join(_all(assets), "url", "left_anti")))
            n_assets += assets[-1].count()
        reads.append(pages.select("url", "status", "content_type", "title", "visit", F.lit(listing).alias("listing")))
        found.append(links)
        return links

    def tell(message: str) -> None:
        if progress is not None:
            progress(message, visit)

    for number in range(config.max_pages):
        url = U.listing_url(config.base_url, number)
        links = gather(fetch(F.broadcast(spark.createDataFrame([(url,)], "url string"))).withColumn("visit", F.lit(visit).cast("long")), True)
        visit += 1
        status = reads[-1].select("status").first()[0]
        size, *mark = signature(links).first()
        mark = (size, *mark)
        tell(f"listing page {number}: {size} links")
        if status != 200 or number > 0 and (mark in signatures or not size):
            break
        signatures.add(mark)

    frontier, followed = _all(found), 0
    while True:
        room = None if config.max_follow_pages is None else config.max_follow_pages - followed
        # Pages seen before the last level have been read, or a limit has ended the crawl.
        pages = frontier.filter(F.col("kind").isin("dataset_page", "documentation_page")).groupBy("url").agg(F.min(_place(F.col("link_no"))).alias("at"))
        new = pages.join(_all(levels), "url", "left_anti")
        level, size = counted_ranks(new if room is None else new.orderBy("at").limit(max(0, room)), "at", "visit", visit)
        if not size:
            break
        level = level.select("url", "visit")
        levels.append(level.select("url"))
        small = F.broadcast if size <= SENT else lambda urls: urls
        frontier = gather(fetch(small(level.select("url"))).join(small(level), "url"), False)
        visit, followed = visit + size, followed + size
        tell(f"{followed} follow pages, {n_assets} assets")

    read, links = _all(reads), _all(found)
    seen = read.select("url", "title", F.lit("").alias("source_url"), F.lit("").alias("source_title"), _place().alias("at"), F.col("listing").alias("counts")).unionByName(
        links.select("url", "title", "source_url", "source_title", _place(F.col("link_no")).alias("at"), F.lit(True).alias("counts")))
    rows = merged(seen, "url", ["title", "source_url", "source_title"], "at")
    # A page's own reading counts as a sighting only for a listing page.
    sightings = seen.filter("counts").groupBy("url").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))
    duplicates = sightings.first()[0]
    linked = links.groupBy("visit").agg(F.countDistinct("url").cast("int").alias("linked_documents"))
    own = read.join(linked, "visit", "left").withColumn("linked_documents", F.coalesce("linked_documents", F.lit(0)))
    last = own.groupBy("url").agg(F.max_by(F.struct("status", "content_type", "linked_documents", "listing"), "visit").alias("r")).select(F.col("url").alias("_page"), "r.*")
    # Cut, so that an asset is asked about once.
    probed = cut(probe(_assets(links)).select(F.col("url").alias("_asset"), F.col("status").alias("a_status"), F.col("content_type").alias("a_type")))
    joined = rows.join(last, F.col("url") == F.col("_page"), "left").join(probed, F.col("url") == F.col("_asset"), "left")
    status = F.coalesce("status", "a_status")
    kind = F.when(F.coalesce("listing", F.lit(False)), "listing_page").otherwise(U.resource_kind(F.col("url")))
    content = text_of(F.coalesce("content_type", "a_type"))
    inventory = joined.select(
        "url", "title", kind.alias("resource_kind"), F.when(F.col("_asset").isNotNull(), U.asset_kind(F.col("url"), content)).otherwise("").alias("asset_kind"), content.alias("content_type"),
        status.cast("int").alias("http_status"), U.link_state(status).alias("link_state"), F.coalesce("linked_documents", F.lit(0)).alias("linked_documents"), "source_url", "source_title",
    )
    order = F.array_position(F.array(*map(F.lit, ("listing_page", "dataset_page", "documentation_page", "asset", "other"))), F.col("resource_kind"))
    inventory = cut(inventory.orderBy(order, "url"))
    return Crawl(inventory, kind_counts(inventory) | {"duplicates_skipped": duplicates})


def signature(links: DataFrame) -> DataFrame:
    """One row that two link lists share if they hold the same URLs: how many, and two sums over 60 bits of each one's SHA-1.

    Sums are made up in part before they meet, so no list is ever gathered.
    """
    bits = lambda at: F.conv(F.substr(F.sha1("url"), F.lit(at), F.lit(15)), 16, 10).cast("long")
    return links.select("url").distinct().agg(F.count("*").alias("urls"), F.coalesce(F.bit_xor(bits(1)), F.lit(0)).alias("first_bits"), F.coalesce(F.bit_xor(bits(16)), F.lit(0)).alias("more_bits"))


def kind_counts(inventory: DataFrame) -> dict[str, int]:
    """Rows of each resource kind, all rows, dead links, and unknown ones with a transient status."""
    transient = (F.col("link_state") == "unknown") & F.col("http_status").isin(*U.TRANSIENT)
    kinds = {r["resource_kind"]: r["n"] for r in inventory.groupBy("resource_kind").agg(F.count("*").alias("n")).collect()}
    total, dead, unknown = inventory.agg(F.count("*"), F.count_if(F.col("link_state") == "dead"), F.count_if(transient)).first()
    return kinds | {"total_urls": total, "dead_links": dead, "transient_links": unknown}
