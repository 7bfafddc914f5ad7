"""Source lists, selectors, keyword rules and word lists.

Everything in this file is data that must hold exactly these values for right results. It is
small and bounded, so it may travel to tasks inside closures and literals.
"""

from __future__ import annotations

# Ordered keyword rules for story categories, first match wins.
CATEGORY_RULES = (
    ("programming", ("code", "programming", "developer", "software", "git")),
    ("technology", ("ai", "tech", "computer", "app", "digital")),
    ("science", ("science", "research", "study", "physics", "biology")),
    ("business", ("startup", "business", "money", "finance", "market")),
)
DEFAULT_CATEGORY = "general"

# Limits per fetched document.
ITEMS_PER_SOURCE = 10
STORIES_PER_LIST = 50
NEWS_CONTENT_CHARS = 500
ABSTRACT_CHARS = 1000
NEWS_TITLE_MIN_CHARS = 10

# Texts that stand for absent fields.
FEED_DEFAULTS = {
    "source": "Unknown",
    "title": "No title",
    "content": "No content",
    "url": "No URL",
}
FORUM_DEFAULTS = {"title": "No title", "url": "", "author": "Unknown", "score": "0"}
NEWS_CONTENT_DEFAULT = "No content preview available"
UNKNOWN_AUTHOR_PREFIX = "Unknown author - "
NO_ABSTRACT_PREFIX = "No abstract available - "
STORY_AUTHOR_DEFAULT = "anonymous"
STORY_LINK_PREFIX = "https://news.ycombinator.com/item?id="
FORUM_LINK_PREFIX = "https://reddit.com"

# Feeds by category.
NEWS_FEEDS = (
    ("science", "http://feeds.nature.com/nature/rss/current"),
    ("science", "http://feeds.sciencedaily.com/sciencedaily"),
    ("technology", "https://www.wired.com/feed/rss"),
    ("technology", "https://feeds.feedburner.com/TechCrunch"),
    ("crypto", "https://cointelegraph.com/rss"),
    ("crypto", "https://coindesk.com/arc/outboundfeeds/rss/"),
    ("stock_market", "https://seekingalpha.com/feed.xml"),
    ("stock_market", "https://www.investing.com/rss/news.rss"),
    ("general_news", "http://rss.cnn.com/rss/cnn_topstories.rss"),
    ("general_news", "https://www.npr.org/rss/rss.php?id=1001"),
)

# Scholarly feeds as (name, url, category, language).
SCHOLARLY_FEEDS = (
    ("ArXiv AI", "http://export.arxiv.org/rss/cs.AI", "ai_research", "en"),
    ("MIT Technology Review", "https://www.technologyreview.com/feed/", "tech_innovation", "en"),
    (
        "ScienceDaily",
        "https://www.sciencedaily.com/rss/computers_math/artificial_intelligence.xml",
        "ai_news",
        "en",
    ),
    ("IEEE Spectrum", "https://spectrum.ieee.org/feeds/feed.rss", "computing", "en"),
)

# Forum sections and the address of their listing pages.
FORUM_SECTIONS = (
    "science",
    "technology",
    "CryptoCurrency",
    "wallstreetbets",
    "investing",
    "news",
    "worldnews",
    "datascience",
)
FORUM_PAGE_URL = "https://old.reddit.com/r/{section}/hot/"
FORUM_SELECTORS = {
    "block": "div.thing",
    "title": "a.title",
    "author": "a.author",
    "score": 'div[class="score unvoted"]',
}

# News sites as (category, url, block, title, link); no title selector means the
# whole block is the title.
NEWS_SITES = (
    ("technology", "https://techcrunch.com", "article", "h2, h3", "a"),
    ("technology", "https://www.theverge.com", "h2", None, "a"),
    ("science", "https://www.scientificamerican.com/latest-news/", "article", "h2", "a"),
    ("science", "https://phys.org", "article", "h3", "a"),
    ("crypto", "https://decrypt.co/", "article", "h3", "a"),
    ("crypto", "https://www.coindesk.com", "article", "h3, h4", "a"),
    ("stock_market", "https://www.marketwatch.com", "div.article-wrap", "h3", "a"),
    ("stock_market", "https://www.investors.com/news/", "article", "h3", "a"),
)
NEWS_SUMMARY_SELECTOR = "p, .summary, .excerpt"

# Scholarly and technology sites.
SCHOLARLY_SITES = (
    {
        "name": "HackerNews",
        "url": "https://news.ycombinator.com/",
        "category": "tech_innovation",
        "block": ".athing",
        "title": ".titleline > a",
        "author": ".hnuser",
        "abstract": ".subtext",
        "link_prefix": "",
        "language": "en",
    },
    {
        "name": "ArXiv CS",
        "url": "https://arxiv.org/list/cs.AI/recent",
        "category": "ai_research",
        "block": "dl",
        "title": "dt .list-title",
        "author": "dd.meta",
        "abstract": "p.mathjax",
        "link_prefix": "https://arxiv.org",
        "language": "en",
    },
    {
        "name": "Nature",
        "url": "https://www.nature.com/nature/articles",
        "category": "science",
        "block": "article",
        "title": "h3 a",
        "author": "ul.c-author-list",
        "abstract": "div.c-card__summary",
        "link_prefix": "https://www.nature.com",
        "language": "en",
    },
    {
        "name": "TechCrunch",
        "url": "https://techcrunch.com/",
        "category": "tech_news",
        "block": "article",
        "title": "h2 a",
        "author": "span.river-byline__authors",
        "abstract": "div.post-block__content",
        "link_prefix": "",
        "language": "en",
    },
    {
        "name": "Wired",
        "url": "https://www.wired.com/category/science/",
        "category": "science_tech",
        "block": "div.SummaryItemWrapper-gdEuvf",
        "title": "h3 a",
        "author": "span.byline-name",
        "abstract": "div.summary-item__dek",
        "link_prefix": "https://www.wired.com",
        "language": "en",
    },
    {
        "name": "VentureBeat",
        "url": "https://venturebeat.com/",
        "category": "tech_business",
        "block": "article",
        "title": "h2 a",
        "author": "span.author",
        "abstract": "p.entry-excerpt",
        "link_prefix": "",
        "language": "en",
    },
    {
        "name": "The Verge",
        "url": "https://www.theverge.com/tech",
        "category": "consumer_tech",
        "block": "div.duet--content-cards--content-card",
        "title": "h2 a",
        "author": "span.duet--attribution--author-name",
        "abstract": "p.duet--content-cards--content-card-description",
        "link_prefix": "https://www.theverge.com",
        "language": "en",
    },
    {
        "name": "Geektime Israel",
        "url": "https://www.geektime.co.il/",
        "category": "israel_tech",
        "block": "article",
        "title": "h2 a",
        "author": "span.author",
        "abstract": "div.entry-summary",
        "link_prefix": "",
        "language": "he",
    },
    {
        "name": "Globes Tech",
        "url": "https://www.globes.co.il/news/home.aspx?fid=594",
        "category": "israel_tech",
        "block": "div.news-item-container",
        "title": "h3 a",
        "author": "span.author",
        "abstract": "p.news-item-content",
        "link_prefix": "https://www.globes.co.il",
        "language": "he",
    },
)

# Selectors tried in this order when a scholarly site's own selector finds nothing.
FALLBACK_SELECTORS = {
    "block": (
        "article",
        ".article",
        ".post",
        ".item",
        ".entry",
        "div.card",
        "div.news-item",
        "li.news-item",
    ),
    "title": (
        "h1 a",
        "h2 a",
        "h3 a",
        "h4 a",
        ".title a",
        ".headline a",
        ".entry-title a",
        "a.title",
    ),
    "author": (".author", ".byline", ".meta-author", ".writer", ".contributor", "span.by"),
    "abstract": (
        "p",
        ".summary",
        ".excerpt",
        ".description",
        ".teaser",
        ".intro",
        ".snippet",
    ),
}
# Last resorts of the scholarly rules.
GENERAL_BLOCK_TAGS = ("article", "div", "li")
GENERAL_BLOCK_CLASS_PARTS = ("post", "article", "item", "entry", "card", "news")
ANY_HEADING_SELECTOR = "h1, h2, h3, h4, h5"
DATE_SELECTOR = ".date, .time, time, .published, .post-date"
DATE_CLASS_PART = "date"

# The English stop words that Spark ships as its default list.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now i'll you'll
    he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
    how's let's ought that's there's what's when's where's who's why's would
    """.split()
)

# Texts of insight rows.
MULTIPLE_SOURCES = "multiple sources"
TOPIC_SOURCE = "topic modeling"
POSITIVE_DESCRIPTION = "This content has a very positive sentiment score"
