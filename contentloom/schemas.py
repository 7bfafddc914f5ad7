"""Table schemas. Ids are 64 bit: a table of this size outgrows 32 bit keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RAW_NEWS = """
    id bigint, source string, category string, title string, content string, url string,
    published_date timestamp, extracted_date timestamp
"""
_RAW_POSTS = """
    id bigint, subreddit string, title string, author string, url string, score int,
    created_utc timestamp, extracted_date timestamp
"""
_RAW_SCHOLARLY = """
    id bigint, source string, category string, title string, authors string, abstract string,
    url string, published_date timestamp, extracted_date timestamp, language string
"""

_FEED_PAYLOADS = """
    feed_url string, source_name string, category string, language string, status int,
    body string, fetched_at timestamp
"""

_DDL = {
    "news_articles": _RAW_NEWS,
    "reddit_posts": _RAW_POSTS,
    "scholarly_articles": _RAW_SCHOLARLY,
    "transformed_news_articles": _RAW_NEWS
    + """,
    clean_title string, clean_content string, title_tokens array<string>,
    content_tokens array<string>, content_length int, source_normalized string,
    category_normalized string, published_date_normalized date, transformation_date timestamp,
    sentiment_score double
    """,
    "transformed_reddit_posts": _RAW_POSTS
    + """,
    clean_title string, title_tokens array<string>, subreddit_normalized string,
    popularity_level string, created_date date, transformation_date timestamp,
    sentiment_score double
    """,
    "transformed_scholarly_articles": _RAW_SCHOLARLY
    + """,
    clean_title string, clean_abstract string, title_tokens array<string>,
    abstract_tokens array<string>, abstract_length int, author_count int,
    source_normalized string, category_normalized string, published_date_normalized date,
    transformation_date timestamp, sentiment_score double
    """,
    "unified_content": """
    id bigint, source string, category string, title string, content string, url string,
    published_date date, sentiment_score double, content_type string, unified_id string,
    processed_timestamp timestamp
    """,
    "category_days": """
    category string, rows bigint, scored bigint, sentiment_sum double, content_type string,
    published_date date
    """,
    "id_ranges": """
    table_name string, first_id bigint, rows bigint, batch_id string, state string, token string,
    recorded_at timestamp
    """,
    "content_insights": """
    id bigint not null, insight_type string not null, title string not null,
    description string not null, sources array<string> not null,
    related_content_ids array<string>, score double not null, generated_at timestamp not null
    """,
    "news_feed_payloads": _FEED_PAYLOADS,
    "scholarly_feed_payloads": _FEED_PAYLOADS,
    "story_payloads": "pos int, story_id bigint, body string, fetched_at timestamp",
    "rejected_rows": "table_name string, reject_reason string, row string, batch_id string",
    "page_payloads": "url string, profile string, status int, html string, fetched_at timestamp",
}


#: Columns by which stored tables are laid out in folders: their types and what they are made of. Each
#: run of the insights job has a folder of its own inside its day, each kind of page has one.
LAYOUT: dict[str, dict[str, tuple[str, str]]] = {
    "content_insights": {
        "generated_day": ("date", "to_date(generated_at)"),
        "generated_run": ("string", "date_format(generated_at, 'yyyyMMddHHmmssSSSSSS')"),
    },
    "page_payloads": {"page_profile": ("string", "profile")},
}

# The declared widths of text columns, and the default of the column added later.
WIDTHS: dict[str, dict[str, int]] = {
    "news_articles": {"source": 255, "category": 255},
    "reddit_posts": {"subreddit": 255, "author": 255},
    "scholarly_articles": {"source": 255, "category": 255, "language": 10},
    "transformed_news_articles": {"source_normalized": 255, "category_normalized": 255},
    "transformed_reddit_posts": {
        "subreddit": 255,
        "subreddit_normalized": 255,
        "author": 255,
        "popularity_level": 50,
    },
    "transformed_scholarly_articles": {
        "source": 255,
        "source_normalized": 255,
        "category": 255,
        "category_normalized": 255,
    },
    "unified_content": {"source": 255, "category": 255, "content_type": 50, "unified_id": 100},
    "content_insights": {"insight_type": 50},
}
_DEFAULTS = {
    "scholarly_articles": {"language": "'en'"},
    "transformed_scholarly_articles": {"language": "'en'"},
}


def schema(table: str) -> T.StructType:
    """The columns of a table; raises ``KeyError`` for an unknown name."""
    return T.StructType.fromDDL(_DDL[table])


def is_known(table: str) -> bool:
    return table in _DDL


def defaults(table: str) -> dict[str, str]:
    """SQL literals that stand for columns a stored row does not have."""
    return _DEFAULTS.get(table, {})


def read_schema(table: str, with_layout: bool = True) -> T.StructType:
    """``schema`` for readers of files, with the layout's columns; files written before a column existed
    show its default."""
    kept = {
        name: {"CURRENT_DEFAULT": value, "EXISTS_DEFAULT": value} for name, value in defaults(table).items()
    }
    fields = [T.StructField(f.name, f.dataType, f.nullable, kept.get(f.name)) for f in schema(table).fields]
    return T.StructType(fields + (_layout_fields(table) if with_layout else []))


def _layout_fields(table: str) -> list[T.StructField]:
    kinds = ", ".join(f"{name} {kind}" for name, (kind, _) in LAYOUT.get(table, {}).items())
    return T.StructType.fromDDL(kinds).fields if kinds else []


def laid_out(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the columns by which the table is laid out."""
    return df.withColumns({name: F.expr(made) for name, (_, made) in LAYOUT.get(table, {}).items()})


def table_ddl(table: str) -> str:
    """Column definitions for a catalog: declared widths, required columns and defaults."""
    widths, known = WIDTHS.get(table, {}), defaults(table)

    def column(field: T.StructField) -> str:
        kind = f"VARCHAR({widths[field.name]})" if field.name in widths else field.dataType.simpleString()
        required = "" if field.nullable else " NOT NULL"
        default = f" DEFAULT {known[field.name]}" if field.name in known else ""
        return f"{field.name} {kind}{required}{default}"

    return ", ".join(column(f) for f in [*schema(table).fields, *_layout_fields(table)])


def declared_rules(df: DataFrame, table: str) -> dict[str, Column]:
    """Rules a row must keep to be stored: text columns within their width, required ones present."""
    rules = {
        f"{name} is longer than {width}": F.char_length(name) > width
        for name, width in WIDTHS.get(table, {}).items()
        if name in df.columns
    }
    required = [f.name for f in schema(table).fields if not f.nullable and f.name in df.columns]
    return rules | {f"{name} is missing": F.col(name).isNull() for name in required}


def ensure_column(df: DataFrame, name: str, default: Column) -> DataFrame:
    """A column added after rows were stored: those rows show the default."""
    known = F.coalesce(F.col(name), default) if name in df.columns else default
    return df.withColumn(name, known)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``df`` in the order and types of a table, absent ones as their default or NULL."""
    present, known = set(df.columns), defaults(table)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.expr(known.get(f.name, "NULL")))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema(table).fields
        ]
    )
