"""Article titles and texts out of a document table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordbase.operators.keyed import hot_keys, row_key, spread_join
from wordbase.runtime import stored, stored_in_buckets


def category_titles(
    articles: DataFrame, limit: int, category: str | None = None
) -> DataFrame:
    """Up to ``limit`` titles of a category, or of every category when none is given.

    ``articles(category, title)``. Titles are taken in title order.
    """
    if category is not None:
        return (
            articles.filter(F.col("category") == category)
            .select("category", "title")
            .orderBy("title")
            .limit(limit)
        )
    # A row_number filter on a constant is cut to `limit` rows per category in each map
    # task, before the shuffle, so a huge category costs one task no more than the rest.
    rank = F.row_number().over(Window.partitionBy("category").orderBy("title"))
    return (
        articles.select("category", "title", rank.alias("rank"))
        .filter(F.col("rank") <= limit)
        .drop("rank")
    )


#: Titles of so many categories are fetched by naming the categories to the scan.
NAMED_CATEGORIES = 1000
CATEGORY_KEY = ["_category", "_uncategorised"]


def _place(titles: DataFrame, articles: DataFrame) -> list[str]:
    """What names an article: its title, and its category where both tables have one."""
    both = "category" in titles.columns and "category" in articles.columns
    return ["category", "title"] if both else ["title"]


def with_category_key(table: DataFrame) -> DataFrame:
    """``table`` with ``CATEGORY_KEY``, which compares categories so that those without one are equal."""
    category = F.col("category")
    return table.withColumns(dict(zip(CATEGORY_KEY, (F.coalesce(category, F.lit("")), category.isNull()), strict=True)))


def of_categories(articles: DataFrame, titles: DataFrame) -> DataFrame:
    """The articles of the titles' categories.

    Their names become a filter, which prunes a table that is partitioned by category. Of more than
    ``NAMED_CATEGORIES`` categories all articles are left to the join.
    """
    if "category" not in _place(titles, articles):
        return articles
    names = titles.select("category").distinct().limit(NAMED_CATEGORIES + 1).collect()
    if len(names) > NAMED_CATEGORIES:
        return articles
    known = [r["category"] for r in names if r["category"] is not None]
    named = F.col("category").isin(known)
    return articles.filter(named if len(known) == len(names) else named | F.col("category").isNull())


def lay_out_articles(articles: DataFrame, buckets: int) -> DataFrame:
    """``articles(category, title, text)``, one page each, written once in buckets by category and title.

    Titles are then joined to it, batch after batch, by a shuffle of the titles alone: it is what ``found_texts`` and
    ``article_texts`` take with ``unique=True``. Choose as many buckets as the tasks that are to read all texts.
    """
    return stored_in_buckets(with_category_key(articles), "articles", [*CATEGORY_KEY, "title"], buckets)


def _in_buckets(titles: DataFrame, pages: DataFrame, on: list[str], how: str) -> DataFrame:
    """``titles`` joined to articles in buckets, which stay where they are.

    A title that comes in very many rows would make a hot bucket. There are fewer such titles than 16 times the partitions; their
    articles are looked up by a broadcast, and joined in pieces.
    """
    hot, _ = hot_keys(titles, on)
    keys = [k for part in hot.values() for k in part if k is not None]
    if not keys:
        return titles.join(pages, on, how)
    is_hot = F.coalesce(row_key(on).isin(keys), F.lit(False))
    crowded = titles.where(is_hot)
    few = stored(pages.join(F.broadcast(crowded.select(*on).distinct()), on, "left_semi"), "hot_articles")
    return titles.where(~is_hot).join(pages, on, how).unionByName(spread_join(crowded, few, on, how, repeats=True))


def _with_texts(titles: DataFrame, articles: DataFrame, unique: bool, how: str) -> DataFrame:
    """``titles`` joined to the text of the first page that has one.

    Texts are by far the widest column, so they are read and moved once: which page comes first is
    found without them, and a short title list is broadcast to the articles. Articles that are laid out in buckets are not moved at all.
    """
    on = _place(titles, articles)
    laid_out = set(CATEGORY_KEY) <= set(articles.columns)
    if laid_out and not (unique and "category" in on):
        raise ValueError("articles in buckets are joined by category and title, one page each")
    if "category" in on:
        titles, articles = with_category_key(titles), articles if laid_out else with_category_key(articles)
        on = [*CATEGORY_KEY, "title"]
    pages = articles.filter(F.col("text").isNotNull())
    if laid_out:
        return _in_buckets(titles, pages.select(*on, "text"), on, how)
    if unique:
        return spread_join(titles, pages.select(*on, "text"), on, how, repeats=True)
    if "page" not in articles.columns:
        only = pages.groupBy(*on).agg(F.min("text").alias("text"))
        return spread_join(titles, only, on, how, repeats=True)
    first = pages.groupBy(*on).agg(F.min("page").alias("page"))
    wanted = spread_join(titles, first, on, how, repeats=True)
    keys = [*on, "page"]
    return spread_join(wanted, pages.select(*keys, "text"), keys, how, repeats=True)


def found_texts(titles: DataFrame, articles: DataFrame, unique: bool = False) -> DataFrame:
    """The texts of the titles that have one; titles may repeat.

    ``articles(title, text)`` may hold several pages per title, in ``page`` order; the first page
    that has a text wins. ``unique=True`` promises one page per title. Where both tables have a ``category``, an
    article is named by category and title; articles without a category are named by titles without one.
    """
    return _with_texts(titles, articles, unique, "inner").select(*titles.columns, "text")


def article_texts(titles: DataFrame, articles: DataFrame, unique: bool = False) -> DataFrame:
    """The text of each title as by ``found_texts``, ``""`` when there is none."""
    found = _with_texts(titles, articles, unique, "left")
    return found.select(*titles.columns, F.coalesce("text", F.lit("")).alias("text"))
