"""The checked queries in SQL, from the driver's tables alone."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, product

from barsignal.functions.scalars import SENTIMENT_LABELS
from barsignal.operators.features import FEATURE_GROUPS, FEATURES, MODEL_GROUPS
from barsignal.operators.metrics import METRICS
from barsignal.operators.sentiment import NEGATIVE_WORDS, POSITIVE_WORDS

START, END = "1996-01-01", "1999-12-31"
PLACES = 6
# Averages of exact 128ths have short decimals: round beyond them, not at a tie.
PLACES_OF = dict.fromkeys(
    ("negative", "neutral", "positive", "Sent_Net", "Sent_MA5", "Sent_Mom5", "Sent_Lag3"), 12
)

CTES: dict[str, str] = {
    "lines": """
        select p_brand as Stock_symbol, cast(l_shipdate as date) as Date, l_extendedprice as px,
               l_extendedprice * (1 - l_discount) as adj, l_quantity as q,
               row_number() over (partition by p_brand, cast(l_shipdate as date)
                 order by l_orderkey, l_linenumber, l_extendedprice, l_discount, l_quantity) as rf,
               row_number() over (partition by p_brand, cast(l_shipdate as date)
                 order by l_orderkey desc, l_linenumber desc, l_extendedprice desc,
                          l_discount desc, l_quantity desc) as rl
        from lineitem join part on l_partkey = p_partkey""",
    "prices": """
        select Date, max(px) filter (where rf = 1) as Open, max(px) as High, min(px) as Low,
               max(px) filter (where rl = 1) as Close, max(adj) filter (where rl = 1) as "Adj Close",
               cast(sum(q) as bigint) as Volume, Stock_symbol
        from lines group by Date, Stock_symbol""",
    "raw_prices": """
        select cast(Date as varchar) as Date, case when day(Date) = 13 then null else Open end as Open,
               High, Low, Close, "Adj Close", Volume, Stock_symbol
        from prices""",
    "news": """
        select distinct o_orderkey as No, cast(o_orderdate as date) as Date, p_brand as Stock_symbol
        from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey""",
    "draws": """
        select distinct o_orderkey as No, cast((o_orderkey * 37 + 11) % 65 as double) as a,
               cast((o_orderkey * 53 + 7) % 64 as double) as b
        from orders where o_orderkey in (select l_orderkey from lineitem)""",
    "probabilities": "select No, b / 128 as negative, (128 - a - b) / 128 as neutral, a / 128 as positive from draws",
    "scores": """
        select *, case when negative >= neutral and negative >= positive then 'negative'
                       when neutral >= positive then 'neutral' else 'positive' end as predicted_sentiment
        from probabilities""",
    "sectors": """
        select distinct p_brand as Stock_symbol,
               concat('Sector_', cast(cast(substr(p_brand, 7) as int) % 6 as varchar)) as category
        from part where cast(substr(p_brand, 7) as int) % 6 <> 5""",
    "articles": "select n.*, s.negative, s.neutral, s.positive, s.predicted_sentiment from news n join scores s using (No)",
    "averages": """
        select Date, Stock_symbol, avg(negative) as negative, avg(neutral) as neutral,
               avg(positive) as positive, count(No) as article_count
        from articles group by Date, Stock_symbol""",
    "daily": """
        select *, case when positive >= neutral and positive >= negative then 'positive'
                       when neutral >= positive and neutral >= negative then 'neutral'
                       else 'negative' end as predicted_sentiment
        from averages""",
    "joined": """
        select p.*, d.negative, d.neutral, d.positive, d.article_count, d.predicted_sentiment
        from prices p left join daily d using (Date, Stock_symbol)""",
    "panel": """
        select j.* exclude (negative, neutral, positive, article_count, predicted_sentiment),
               coalesce(negative, 0.0) as negative, coalesce(neutral, 1.0) as neutral,
               coalesce(positive, 0.0) as positive, coalesce(article_count, 0) as article_count,
               coalesce(predicted_sentiment, 'neutral') as predicted_sentiment,
               article_count is not null as has_news, coalesce(category, 'Miscellaneous') as category
        from joined j left join sectors using (Stock_symbol)""",
    "raw_news": """
        select case when doc_id % 11 = 0 then concat(doc_id, '.0') when doc_id % 13 = 0 then 'n/a'
                    else cast(doc_id as varchar) end as No,
               case when doc_id % 17 = 0 then 'yesterday'
                    else concat(cast(date '1995-01-01' + cast(doc_id % 2000 as int) as varchar), ' 23:30:00 UTC') end as Date,
               concat('Note "', doc_id, '", ', lang) as Article_title,
               concat('Brand#', doc_id % 6 + 1, (doc_id // 6) % 6 + 1) as Stock_symbol,
               case when doc_id % 7 <> 0 then concat('https://news.example/', doc_id) end as Url,
               source as Publisher, lang as Author, text as Article, text as Lsa_summary,
               lang as Luhn_summary, lang as Textrank_summary, lang as Lexrank_summary
        from documents""",
    "preds": """
        select cast(event_id % 8 as int) as fold, cast(ts as date) as Date,
               concat('U', cast(user_id as varchar)) as Stock_symbol,
               case when event_type in ('purchase', 'signup') then 1 else 0 end as y_test,
               cast((event_id * 29) % 97 + 1 as double) / 98 as y_prob,
               case when cast((event_id * 29) % 97 + 1 as double) / 98 > 0.5 then 1 else 0 end as y_pred
        from events""",
}


def over(start: int, end: int = 0, order: str = "Date") -> str:
    def edge(n: int) -> str:
        return "current row" if n == 0 else f"{abs(n)} {'preceding' if n < 0 else 'following'}"

    return f"over (partition by Stock_symbol order by {order} rows between {edge(start)} and {edge(end)})"


def roll(fn: str, x: str, n: int) -> str:
    return f"case when count({x}) {over(1 - n)} = {n} then {fn}({x}) {over(1 - n)} end"


def lag(x: str, k: int) -> str:
    return f"lag({x}, {k}) over (partition by Stock_symbol order by Date)"


ADJ = '"Adj Close"'

CTES["daily_returns"] = f"select *, Close / nullif({lag('Close', 1)}, 0) - 1 as Daily_Return from panel"
CTES["up_days"] = "select *, case when Daily_Return > 0 then 1 else 0 end as Up_Day from daily_returns"
CTES["next_up"] = "select *, lead(Up_Day, 1) over (partition by Stock_symbol order by Date) as next_up from up_days"
CTES["up_counts"] = f"select * exclude (next_up), cast({roll('sum', 'next_up', 5)} as bigint) as Up_Count_5d from next_up"
CTES["labelled"] = "select *, case when Up_Count_5d >= 3 then 1 else 0 end as Label from up_counts"
CTES["f1"] = f"""
    select *, {", ".join(f"{ADJ} / nullif({lag(ADJ, k)}, 0) - 1 as Return_{k}d" for k in (1, 5, 20))},
           {lag(ADJ, 1)} as prev_adj, {lag("Volume", 1)} as prev_volume,
           {roll("avg", ADJ, 5)} as MA5, {roll("avg", ADJ, 20)} as MA20,
           {roll("max", "High", 20)} as High_20, {roll("min", "Low", 20)} as Low_20,
           {roll("avg", "Volume", 20)} as Vol_MA20, {roll("avg", "Volume", 5)} as Vol_MA5,
           {roll("avg", "article_count", 20)} as Art_MA20, positive - negative as Sent_Net
    from labelled"""
CTES["f2"] = f"""
    select *, {ADJ} / nullif(MA5, 0) as MA5_Ratio, {ADJ} / nullif(MA20, 0) as MA20_Ratio,
           (MA5 - MA20) / nullif(MA20, 0) as Trend_5_20,
           ({ADJ} - High_20) / nullif(High_20, 0) as Dist_20High, ({ADJ} - Low_20) / nullif(Low_20, 0) as Dist_20Low,
           {roll("stddev_samp", "Return_1d", 5)} as Vol_5d, {roll("stddev_samp", "Return_1d", 20)} as Vol_20d,
           (Open - prev_adj) / nullif(prev_adj, 0) as Gap, Volume / nullif(prev_volume, 0) - 1 as Vol_Change,
           Volume / nullif(Vol_MA20, 0) as Vol_Ratio_20, Vol_MA5 / nullif(Vol_MA20, 0) as Vol_Trend,
           {roll("avg", "Sent_Net", 5)} as Sent_MA5, Sent_Net - {lag("Sent_Net", 5)} as Sent_Mom5,
           article_count / nullif(Art_MA20, 0) as News_Intensity,
           {lag("Return_1d", 1)} as Ret_Lag1, {lag("Return_5d", 5)} as Ret_Lag5, {lag("Sent_Net", 3)} as Sent_Lag3
    from f1"""
CTES["features"] = "select *, Vol_5d / nullif(Vol_20d, 0) as Vol_Ratio, Return_1d * Vol_Ratio_20 as PV_Score from f2"

# The same label on the adjusted close, which the exploration uses.
CTES["adj_returns"] = f"select Stock_symbol, Date, {ADJ} / nullif({lag(ADJ, 1)}, 0) - 1 as change from panel"
CTES["adj_next"] = """
    select *, lead(case when change > 0 then 1 else 0 end, 1) over (partition by Stock_symbol order by Date) as next_up from adj_returns"""
CTES["adj_counts"] = f"select Stock_symbol, Date, cast({roll('sum', 'next_up', 5)} as bigint) as ups from adj_next"
CTES["eda_features"] = """
    select f.* replace (ups as Up_Count_5d, case when ups >= 3 then 1 else 0 end as Label)
    from features f join adj_counts using (Stock_symbol, Date)"""


def z(x: str, window: int = 252) -> str:
    return f"({x} - {roll('avg', x, window)}) / ({roll('stddev_samp', x, window)} + 1e-8)"


CTES["scored"] = f"select *, {', '.join(f'{z(f)} as {f}_z' for f in FEATURES)} from features"
CTES["model_set"] = f"select * from scored where Label is not null and {' and '.join(f'{f}_z is not null' for f in FEATURES)}"


def with_tables(body: str, *extra: tuple[str, str]) -> str:
    """``body`` after the definitions of all tables that it reads."""
    local = dict(extra)
    everything = {**CTES, **local}

    def reads(text: str) -> list[str]:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        return [name for name in everything if name in words]

    needed: dict[str, None] = {}

    def visit(name: str) -> None:
        for other in reads(everything[name]):
            if other != name and other not in needed:
                visit(other)
        needed[name] = None

    for name in reads(body):
        visit(name)
    tables = ",\n".join(f"{name} as materialized ({everything[name]})" for name in needed)
    return f"with {tables}\n{body}" if needed else body


def r(x: str, alias: str | None = None, places: int = PLACES) -> str:
    """Rounded column; adding 0 turns a negative zero into zero."""
    if alias is None:  # a column under its own name
        places = PLACES_OF.get(x, places)
    alias = alias or x
    return f'round({x}, {places}) + 0 as "{alias.strip(chr(34))}"'


def day(x: str = "Date", alias: str | None = None) -> str:
    return f"cast({x} as varchar) as {alias or x}"


def rounded(columns: Sequence[str], places: int = PLACES) -> str:
    return ", ".join(r(c, places=places) for c in columns)


KEY = f"Stock_symbol, {day()}"
SIX = list(METRICS)
SQL: dict[str, str] = {}


def add(name: str, body: str, *extra: tuple[str, str]) -> None:
    SQL[name] = with_tables(body, *extra)


# Sources and sinks
NEWS_SHOWN = """No, Date, Article_title, Stock_symbol, Url, Publisher, Author,
    cast(length(Article) as int) as article_length, md5(Lsa_summary) as summary_md5"""
add("scan_news_csv", f"select {NEWS_SHOWN} from raw_news")
add("scan_quoted_csv", f"select {NEWS_SHOWN} from raw_news")
add("scan_stray_quotes", """
    select cast(doc_id as varchar) as id, case doc_id % 4 when 0 then 'plain "stray" quote' when 1 then '"closed"tail'
      when 2 then 'odd " one' else 'a "b", c' end as field, md5(text) as text_md5, source, cast(0 as bigint) as refused
    from documents where text is not null""")
add("scan_price_csv", f"select {day()}, {rounded(['Open', 'High', 'Low', 'Close', ADJ])}, Volume from raw_prices")
add("archive_ingest", f"""
    select {day()}, {r('Close')}, Volume, upper(Stock_symbol) as Stock_symbol from raw_prices
    where Stock_symbol in (select Stock_symbol from sectors )""")
add("symbol_from_path", """
    select distinct path, case when path like '%.csv' then upper(regexp_extract(path, '([^/]+)[.]csv$', 1)) else '' end as symbol
    from (select concat('s3a://lake/full_history/', lower(p_brand), case when p_size > 25 then '.csv' else '.txt' end) as path from part) t""")
add("scan_parquet", f"select {day()}, {r('Close')}, Stock_symbol from prices where Stock_symbol = 'Brand#12'")
add("sector_dim", "select Stock_symbol, category from sectors")
add("universe_dim", "select distinct p_brand as Stock_symbol from part")
add("export_sector_csv", "select category as sector, category, count(*) as rows from panel group by category")
add("scan_sector_csv", f"""
    select {KEY}, {r('Close', places=8)}, Volume, {r('positive', places=8)}, article_count, has_news, category from panel""")
add("write_by_symbol", f"select {KEY}, {rounded(['Open', 'High', 'Low', 'Close'])}, Volume from prices")
add("write_by_sector", f"select {KEY}, category, {r('Close')}, article_count, has_news from panel")
add("write_parquet", f"select {KEY}, article_count, predicted_sentiment from daily")
TEST_START = "date '1996-11-01' + to_months(cast(fold as int))"
add("export_results_csv", f"""
    select fold, cast(cast({TEST_START} as date) as varchar) as test_start, count(*) as n_test from preds group by fold""")

# Cleaning
add("drop_columns", "select No, Date, Article_title, Stock_symbol, Url, cast(length(Article) as int) as Article, md5(Lsa_summary) as Lsa_summary from raw_news")
add("select_columns", "select No, cast(length(Lsa_summary) as int) as summary_length from raw_news")
add("strip_names", f"select {KEY}, {r('Open')}, Volume from prices")
add("typed_prices", f"select {KEY}, {rounded(['Open', 'Close', ADJ])}, Volume from raw_prices")
add("clean_prices", f"select {KEY}, {rounded(['Open', 'High', 'Low', 'Close', ADJ])}, Volume from raw_prices")
TYPED = (
    "typed",
    """select cast(trunc(try_cast(No as double)) as bigint) as No, try_cast(substr(Date, 1, 10) as date) as Date,
              Article_title, Stock_symbol, Url, Article, Lsa_summary from raw_news""",
)
COMPLETE = "No is not null and Date is not null and Stock_symbol is not null and Url is not null and Article is not null"
add("typed_news", f"select No, {day()}, Stock_symbol, Url from typed", TYPED)
add("drop_any_null", f"select No, {day()}, Stock_symbol, Url from typed where {COMPLETE}", TYPED)
add("clean_news", f"""
    select No, {day()}, Stock_symbol, Url from typed
    where {COMPLETE} and Stock_symbol in (select Stock_symbol from sectors )""", TYPED)
add("in_universe", """
    select No, Stock_symbol from news
    where Stock_symbol in ('Brand#11','Brand#12','Brand#13','Brand#14','Brand#15','Brand#21','Brand#22','Brand#23',
      'Brand#24','Brand#25','Brand#31','Brand#32','Brand#33','Brand#34','Brand#35')""")
add("semi_universe", "select No, Stock_symbol from news where Stock_symbol in (select Stock_symbol from sectors )")
add("drop_null_subset", f"select {KEY}, Label from features where Return_20d is not null and Vol_20d is not null")
add("date_range", f"select {KEY}, {r('Close')} from prices where Date between date '{START}' and date '{END}'")
add("eq_filter", f"select {KEY}, article_count from panel where category = 'Sector_3' and has_news")
add("row_counts", " union all ".join(
    f"select '{t}' as stage, count(*) as rows from {t}" for t in ("prices", "news", "scores", "panel")
))

# Sentiment and merge
THREE = rounded(SENTIMENT_LABELS, 8)
add("news_x_sentiment", f"select No, {KEY}, {THREE}, predicted_sentiment from articles")
add("duplicate_articles", "select No, count(*) as count from news group by No having count(*) > 1")
add("sentiment_distribution", f"""
    select 'all' as stage, predicted_sentiment, count(*) as count from articles group by predicted_sentiment
    union all
    select 'dated', predicted_sentiment, count(*) from articles
    where Date between date '{START}' and date '{END}' group by predicted_sentiment""")
add("daily_sentiment", f"select {KEY}, {THREE}, article_count, predicted_sentiment from daily")
add("price_x_sentiment", f"select {KEY}, {rounded(['Close', 'positive'], 8)}, article_count from joined")
add("has_news", """
    select Stock_symbol, article_count is not null as has_news, count(*) as rows from joined
    group by Stock_symbol, article_count is not null""")
add("fill_neutral", f"select {KEY}, {THREE}, article_count, predicted_sentiment from panel")
add("with_sector", f"select p.Stock_symbol, {day('p.Date', 'Date')}, category from prices p left join sectors using (Stock_symbol)")
add("fill_misc", f"select {KEY}, category from panel")
add("merge", f"""
    select {KEY}, {rounded(['Open', 'High', 'Low', 'Close', ADJ], 8)}, Volume, {THREE}, article_count,
           predicted_sentiment, has_news, category
    from panel where Date between date '{START}' and date '{END}'""")


def _hits(words: Sequence[str]) -> str:
    names = ", ".join(f"'{w}'" for w in words)
    return f"cast(len(list_filter(words, lambda w: w in ({names}))) as double)"


LEXICON = [
    ("tokens", "select doc_id, string_split(regexp_replace(lower(text), '[^a-z]+', ' ', 'g'), ' ') as words from documents"),
    ("logits", f"select doc_id, {_hits(NEGATIVE_WORDS)} as a, cast(1 as double) as b, {_hits(POSITIVE_WORDS)} as c from tokens"),
    ("weights", "select doc_id, exp(a - greatest(a, b, c)) as a, exp(b - greatest(a, b, c)) as b, exp(c - greatest(a, b, c)) as c from logits"),
]
LEXICON_BODY = f"""
    select doc_id, {r('a / (a + b + c)', 'negative', 8)}, {r('b / (a + b + c)', 'neutral', 8)},
           {r('c / (a + b + c)', 'positive', 8)},
           case when a >= b and a >= c then 'negative' when b >= c then 'neutral' else 'positive' end as predicted_sentiment
    from weights"""
add("score_lexicon", LEXICON_BODY, *LEXICON)
add("score_sentiment", LEXICON_BODY, *LEXICON)
add("scan_parquet_batches", f"""
    select predicted_sentiment, count(*) as rows, {r('avg(p)', 'positive', 8)}
    from (select case when a >= b and a >= c then 'negative' when b >= c then 'neutral' else 'positive' end as predicted_sentiment,
                 c / (a + b + c) as p from weights ) t
    group by predicted_sentiment""", *LEXICON)

# Labels, features, z-scores
add("create_labels", f"select {KEY}, {r('Daily_Return')}, Up_Day, Up_Count_5d, Label from labelled")
add("create_labels_forward", f"""
    select {KEY}, {r('Daily_Return')}, Up_Day,
           cast(case when count(Up_Day) {over(1, 5)} = 5 then sum(Up_Day) {over(1, 5)} end as bigint) as Up_Count_5d,
           case when count(Up_Day) {over(1, 5)} = 5 then case when sum(Up_Day) {over(1, 5)} >= 3 then 1 else 0 end end as Label
    from adj_ups""",
    ("adj_returns", f"select *, {ADJ} / nullif({lag(ADJ, 1)}, 0) - 1 as Daily_Return from prices"),
    ("adj_ups", "select *, case when Daily_Return > 0 then 1 else 0 end as Up_Day from adj_returns"))
for name, columns in {
    "returns": ("Return_1d", "Return_5d", "Return_20d"),
    "moving_averages": ("MA5", "MA20", "MA5_Ratio", "MA20_Ratio", "Trend_5_20"),
    "extrema": ("High_20", "Low_20", "Dist_20High", "Dist_20Low"),
    "volatility": ("Vol_5d", "Vol_20d", "Vol_Ratio", "Gap"),
    "volume": ("Vol_Change", "Vol_MA20", "Vol_MA5", "Vol_Ratio_20", "PV_Score", "Vol_Trend"),
    "sentiment_features": ("Sent_Net", "Sent_MA5", "Sent_Mom5"),
    "news_intensity": ("Art_MA20", "News_Intensity"),
    "lag_features": ("Ret_Lag1", "Ret_Lag5", "Sent_Lag3"),
    "all_features": FEATURES,
    "moving_avgs": ("MA5", "MA20"),
    "ma_ratios": ("MA5_Ratio", "MA20_Ratio"),
    "trend": ("Trend_5_20",),
    "dist_extrema": ("Dist_20High", "Dist_20Low"),
    "vol_ratio": ("Vol_Ratio",),
    "gap": ("Gap",),
    "volume_change": ("Vol_Change",),
    "volume_ma": ("Vol_MA20", "Vol_MA5"),
    "volume_ratio": ("Vol_Ratio_20",),
    "pv_score": ("PV_Score",),
    "volume_trend": ("Vol_Trend",),
    "sent_net": ("Sent_Net",),
    "sent_ma5": ("Sent_MA5",),
    "sent_mom5": ("Sent_Mom5",),
    "daily_return": ("Daily_Return",),
}.items():
    add(name, f"select {KEY}, {rounded(columns, 8)} from features")
for name, column in {"up_day": "Up_Day", "up_count_5d": "Up_Count_5d", "label": "Label"}.items():
    add(name, f"select {KEY}, {column} from labelled")
FILLED = 'last_value(gap ignore nulls) over (partition by Stock_symbol order by Date rows unbounded preceding)'
add("all_features_ffill", f"""
    select {KEY}, {', '.join(r(f"px / nullif({lag('px', k)}, 0) - 1", f'Return_{k}d', 8) for k in (1, 5, 20))},
           {r(f"Volume / nullif({lag('Volume', 1)}, 0) - 1", 'Vol_Change', 8)}, {r(roll('avg', 'gap', 5), 'MA5', 8)}
    from filled_bars""",
    ("gap_bars", f"select *, case when day(Date) % 4 <> 1 then {ADJ} end as gap from panel"),
    ("filled_bars", f"select *, {FILLED} as px from gap_bars"))
Z_COLUMNS = [f"{f}_z" for f in FEATURES]
add("zscore", f"select {KEY}, {rounded(Z_COLUMNS, 5)} from scored")
add("zscore_sliding", f"select {KEY}, {', '.join(r(z(x, 60), f'{x}_z', 5) for x in FEATURES)} from features")
add("model_set", f"select {KEY}, category, Label, {rounded(Z_COLUMNS, 5)} from model_set")
add("panel_sort", f"select {KEY}, {r('Close')} from prices order by Stock_symbol, Date")
add("model_matrix", f"""
    select {KEY}, Label, 23 as width, {r(FEATURES[0], 'first')}, {r(FEATURES[-1], 'last')} from features
    where {' and '.join(f'{f} is not null' for f in FEATURES)}""")


# Folds, by comparing dates
def fold_tables(source: str, train: int, test: int, prefix: str = "") -> list[tuple[str, str]]:
    return [
        (f"{prefix}dates", f"""select category, Date, cast(row_number() over (partition by category order by Date) - 1 as int) as i,
            count(*) over (partition by category) as n from (select distinct category, Date from {source} ) d"""),
        (f"{prefix}starts", f"""select category, i as pos, cast((i - {train}) // {test} as int) as fold, n from {prefix}dates
            where i >= {train} and (i - {train}) % {test} = 0"""),
        (f"{prefix}folds", f"""select s.category, s.fold,
            min(Date) filter (where d.i = pos - {train}) as train_start, min(Date) filter (where d.i = pos - 1) as train_end,
            min(Date) filter (where d.i = pos) as test_start,
            min(Date) filter (where d.i = least(pos + {test} - 1, n_last)) as test_end
            from (select *, n - 1 as n_last from {prefix}starts ) s join {prefix}dates d on d.category = s.category
            group by s.category, s.fold"""),
    ]


FOLD_DATES = ", ".join(day(c) for c in ("train_start", "train_end", "test_start", "test_end"))
add("date_index", f"select category, {day()}, i from dates", *fold_tables("model_set", 252, 21))
add("fold_table", f"select category, fold, {FOLD_DATES} from folds", *fold_tables("model_set", 252, 21))
PANEL_FOLDS = fold_tables("panel", 252, 21)
ROLES = ("roles", """
    select p.*, fold, 'train' as role from panel p join folds f on p.category = f.category and Date between train_start and train_end
    union all
    select p.*, fold, 'test' as role from panel p join folds f on p.category = f.category and Date between test_start and test_end""")
add("fold_counts", """
    select category, fold, count(*) filter (where role = 'train') as n_train, count(*) filter (where role = 'test') as n_test
    from roles group by category, fold""", *PANEL_FOLDS, ROLES)
add("assign_folds", """
    select Stock_symbol, category, fold, role, count(*) as rows, cast(sum(Volume) as bigint) as volume
    from roles group by Stock_symbol, category, fold, role""", *PANEL_FOLDS, ROLES)
add("fold_slice", f"select {KEY}, category from panel where Date between date '{START}' and date '{END}'")
add("sector_skip", """
    select category, count(f.fold) as folds, case when count(f.fold) = 0 then 'skipped' else 'kept' end as status
    from (select distinct category from panel ) c left join folds f using (category) group by category""",
    *fold_tables("panel", 2050, 21))
MODEL_NAME = "concat('model_train_', {}, '_to_', {}, '_test_', {}, '_to_', {})".format(
    *[f"strftime({c}, '%Y%m%d')" for c in ("train_start", "train_end", "test_start", "test_end")]
)
SAVED = [
    *fold_tables("panel", 300, 35, "saved_"),
    ("registry", f"select *, concat(category, '/', {MODEL_NAME}) as model_path from saved_folds"),
]
add("match_model", f"""
    select p.category, p.fold, {day('p.test_start', 'test_start')}, {day('p.test_end', 'test_end')}, best.model_path, exact_match
    from folds p left join (
      select *, row_number() over (partition by category, fold order by exact_match desc, days desc, model_start) as rank
      from (select p.category, p.fold, m.model_path, m.test_start as model_start,
                   m.test_start = p.test_start and m.test_end = p.test_end as exact_match,
                   datediff('day', greatest(m.test_start, p.test_start), least(m.test_end, p.test_end)) as days
            from folds p join registry m on m.category = p.category) t
      where exact_match or days > 0) best
    on best.category = p.category and best.fold = p.fold and rank = 1""", *PANEL_FOLDS, *SAVED)
add("format_model_name", "select category, fold, model_path from registry", *SAVED)
add("parse_model_name", f"""
    select category, fold, {', '.join(f"case when fold % 5 <> 0 then cast({c} as varchar) end as {c}"
        for c in ('train_start', 'train_end', 'test_start', 'test_end'))}
    from saved_folds""", *SAVED)
add("sorted_dates", f"select distinct {day()} from panel")
add("distinct_values", "select distinct Stock_symbol from panel")
add("distinct_months", "select distinct cast(cast(date_trunc('month', Date) as date) as varchar) as month from panel")

# Scalars
add("softmax", f"""
    select event_id, {r('a / (a + b + c)', 'negative', 8)}, {r('b / (a + b + c)', 'neutral', 8)}, {r('c / (a + b + c)', 'positive', 8)}
    from w""",
    ("l", "select event_id, value / 50 as a, cast(1 as double) as b, cast(event_id % 10 as double) / 4 as c from events"),
    ("w", "select event_id, exp(a - greatest(a, b, c)) as a, exp(b - greatest(a, b, c)) as b, exp(c - greatest(a, b, c)) as c from l"))
add("argmax_label", """
    select event_id, case when p >= u and p >= g then 'positive' when u >= g then 'neutral' else 'negative' end as label from t""",
    ("t", "select event_id, event_id % 3 as g, (event_id // 3) % 3 as u, (event_id // 9) % 3 as p from events"))
add("argmax_article", """
    select event_id, case when g >= u and g >= p then 'negative' when u >= p then 'neutral' else 'positive' end as label from t""",
    ("t", "select event_id, event_id % 3 as g, (event_id // 3) % 3 as u, (event_id // 9) % 3 as p from events"))
add("threshold", "select event_id, case when event_id % 9 > 4 then 1 else 0 end as y_pred from events")
add("path_stem", """
    select distinct concat('archive.d/', lower(p_brand), case when p_size > 25 then '.us.csv' else '' end) as path,
           concat(lower(p_brand), case when p_size > 25 then '.us' else '' end) as stem
    from part""")
add("is_csv_member", """
    select distinct concat(case when p_size % 2 = 0 then '__MACOSX/' else 'history/' end, p_brand,
             case when p_size % 3 = 0 then '.txt' else '.csv' end) as name,
           p_size % 2 <> 0 and p_size % 3 <> 0 as kept
    from part""")
add("sector_names", "select Stock_symbol, replace(category, '_', ' ') as sector, category as folder from sectors")
add("date_functions", f"""
    select o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d') as text, cast(cast(o_orderdate as date) as varchar) as parsed,
           cast(year(o_orderdate) as int) as year,
           cast(abs(datediff('day', cast(o_orderdate as date), date '{END}')) as int) as days
    from orders""")
add("percent", """
    select event_type, round(sum(user_id % 2) * 100.0::double / count(*), 2) as percent from events group by event_type""")

# Metrics and reports
def metric_tables(by: str) -> list[tuple[str, str]]:
    return [
        ("ranked", f"""select *, rank() over (partition by {by} order by y_prob)
            + (count(*) over (partition by {by}, y_prob) - 1) / 2.0::double as rk from scored_rows"""),
        ("cells", f"""select {by}, cast(count(*) as double) as n,
            cast(count(*) filter (where y_test = 1) as double) as p,
            cast(count(*) filter (where y_test = 1 and y_pred = 1) as double) as tp,
            cast(count(*) filter (where y_test = 0 and y_pred = 1) as double) as fp,
            cast(count(*) filter (where y_test = 1 and y_pred = 0) as double) as fn,
            cast(count(*) filter (where y_test = 0 and y_pred = 0) as double) as tn,
            sum(case when y_test = 1 then rk else 0 end) as rank_sum,
            avg(-ln(case when y_test = 1 then greatest(y_prob, 2.220446049250313e-16)
                         else greatest(1 - y_prob, 2.220446049250313e-16) end)) as log_loss
            from ranked group by {by}"""),
        ("measured", f"""select {by}, n, (rank_sum - p * (p + 1) / 2) / nullif(p * (n - p), 0) as auc, (tp + tn) / n as accuracy,
            coalesce(tp / nullif(tp + fp, 0), 0) as precision, coalesce(tp / nullif(tp + fn, 0), 0) as recall,
            coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1, log_loss from cells"""),
    ]


PREDS = ("scored_rows", "select * from preds")
BY_FOLD = [PREDS, *metric_tables("fold")]
BY_SYMBOL = [PREDS, *metric_tables("Stock_symbol")]
add("auc", f"select fold, {r('auc', places=8)} from measured", *BY_FOLD)
add("auc_by_symbol", f"select Stock_symbol, {r('auc', places=8)} from measured", *BY_SYMBOL)
FOUR = ["accuracy", "precision", "recall", "f1"]
add("classification_metrics", f"select fold, {rounded(FOUR, 8)} from measured", *BY_FOLD)
add("log_loss", f"select fold, {r('log_loss', places=8)} from measured", *BY_FOLD)
FEATURE_FOLDS = fold_tables("features", 252, 21)
add("fold_results", f"""
    select m.category, m.fold, {FOLD_DATES}, {rounded(SIX, 8)}, n_train, n_test
    from measured m join folds f using (category, fold) join counts using (category, fold)""",
    *FEATURE_FOLDS,
    ("scored_rows", """select p.category, fold, Label as y_test, cast(Volume % 97 + 1 as double) / 98 as y_prob,
        case when cast(Volume % 97 + 1 as double) / 98 > 0.5 then 1 else 0 end as y_pred
        from features p join folds f on p.category = f.category and Date between test_start and test_end"""),
    *metric_tables("category, fold"),
    ("counts", """select f.category, f.fold, count(*) filter (where Date between train_start and train_end) as n_train,
        count(*) filter (where Date between test_start and test_end) as n_test
        from features p join folds f on p.category = f.category and Date between train_start and test_end
        group by f.category, f.fold"""))
add("predict_threshold", "select fold, y_pred, count(*) as rows from preds group by fold, y_pred")
CELL_COUNTS = ("cell_counts", """
    select count(*) filter (where y_test = 0 and y_pred = 0) as tn, count(*) filter (where y_test = 0 and y_pred = 1) as fp,
           count(*) filter (where y_test = 1 and y_pred = 0) as fn, count(*) filter (where y_test = 1 and y_pred = 1) as tp
    from preds""")
add("confusion_matrix", "select tn, fp, fn, tp from cell_counts", CELL_COUNTS)
add("confusion_rates", " union all ".join(
    f"""select '{name}' as Metric, {c} as Count, round({c} * 100.0::double / (tn + fp + fn + tp), 2) as Percentage,
        {r('cast(tn as double) / (tn + fp)', 'specificity', 8)}, {r('cast(tp as double) / (tp + fn)', 'sensitivity', 8)}
        from cell_counts"""
    for name, c in (("True Positives", "tp"), ("True Negatives", "tn"), ("False Positives", "fp"), ("False Negatives", "fn"))
), CELL_COUNTS)
add("metrics_overall", f"select {', '.join(r(f'avg({m})', m, 8) for m in SIX)} from measured", *BY_FOLD)
add("metrics_summary", " union all ".join(
    f"""select '{name}' as Metric, {r(f'avg({m})', 'Mean', 8)}, {r(f'stddev_samp({m})', 'Std', 8)},
        {r(f'min({m})', 'Min', 8)}, {r(f'max({m})', 'Max', 8)} from measured"""
    for m, name in METRICS.items()
), *BY_FOLD)
add("metrics_by_year", f"""
    select cast(year({TEST_START}) as int) as year, {', '.join(r(f'avg({m})', m, 8) for m in SIX)}
    from measured group by year({TEST_START})""", *BY_FOLD)
add("metrics_timeline", f"""
    select cast(cast({TEST_START} as date) as varchar) as test_start, {rounded([m for m in SIX if m != 'log_loss'], 8)}
    from measured""", *BY_FOLD)
add("daily_labels", f"select {day()}, {r('avg(y_test)', 'y_test', 8)}, {r('avg(y_pred)', 'y_pred', 8)} from preds group by Date")
add("symbol_metrics", f"select Stock_symbol, {rounded(FOUR, 8)} from measured", *BY_SYMBOL)
add("symbol_leaders", f"""
    select Stock_symbol, {rounded(FOUR, 8)} from (select * from measured order by accuracy desc, Stock_symbol limit 10) t""", *BY_SYMBOL)
add("symbol_laggards", f"""
    select Stock_symbol, {rounded(FOUR, 8)} from (select * from measured order by accuracy, Stock_symbol desc limit 10) t""", *BY_SYMBOL)
add("union_predictions", """
    select fold, Stock_symbol, cast(sum(y_pred) as bigint) as predicted, cast(sum(y_test) as bigint) as actual
    from preds group by fold, Stock_symbol""")
REPORT = {  # key and values of the report's tables
    "metrics_overall": ("''", SIX), "metrics_summary": ("Metric", ["Mean", "Std", "Min", "Max"]), "metrics_by_year": ("cast(year as varchar)", SIX),
    "metrics_timeline": ("test_start", [m for m in SIX if m != "log_loss"]), "confusion_matrix": ("''", ["tn", "fp", "fn", "tp"]),
    "confusion_rates": ("Metric", ["Count", "Percentage", "specificity", "sensitivity"]), "daily_labels": ("Date", ["y_test", "y_pred"]),
    "symbol_metrics": ("Stock_symbol", FOUR), "symbol_leaders": ("Stock_symbol", FOUR), "symbol_laggards": ("Stock_symbol", FOUR),
}
SQL["backtest_report"] = " union all ".join(
    f"""select '{t}' as "table", {key} as key, unnest([{', '.join(f"'{v}'" for v in values)}]) as metric,
        unnest([{', '.join(f'cast({v} as double)' for v in values)}]) as value from ({SQL[t]}) as {t}_table"""
    for t, (key, values) in REPORT.items()
)

# Exploration
add("sector_counts", "select category, count(*) as rows, count(*) over () as categories from panel group by category")
add("distinct_symbols", "select count(distinct Stock_symbol) as symbols from panel")
add("value_counts", f"""
    select Stock_symbol, count(*) as count, {r('count(*) * 100.0::double / (select count(*) from panel )', 'percent')}
    from panel group by Stock_symbol""")
add("label_by_symbol", f"""
    select Stock_symbol, {r('avg(1 - Label)', 'label_0')}, {r('avg(Label)', 'label_1')} from eda_features group by Stock_symbol""")
add("class_balance", """
    select count(*) as original_samples, count(Up_Count_5d) as after_filtering,
           count(*) filter (where Up_Count_5d is not null and Label = 1) as label_1,
           count(*) filter (where Up_Count_5d is not null and Label = 0) as label_0
    from eda_features""")


def describe(source: str, columns: Sequence[str]) -> str:
    return " union all ".join(
        f"""select '{c.strip(chr(34))}' as "column", count({c}) as count, {r(f'avg({c})', 'mean')},
            {r(f'stddev_samp({c})', 'std')}, {r(f'cast(min({c}) as double)', 'min')},
            {', '.join(r(f'quantile_cont(cast({c} as double), {p / 100})', f'p{p}') for p in (25, 50, 75))},
            {r(f'cast(max({c}) as double)', 'max')} from {source}"""
        for c in columns
    )


add("describe_panel", describe("panel", ["Open", "High", "Low", "Close", ADJ, "Volume", *SENTIMENT_LABELS, "article_count"]))
add("describe", describe("features", FEATURES))
add("missing_values", " union all ".join(
    f"""select '{c}' as "column", count(*) - count({c}) as missing,
        round((count(*) - count({c})) * 100.0::double / count(*), 2) as percent from features"""
    for c in ("Stock_symbol", "Date", "Up_Count_5d", *FEATURES)
))


def corr(a: str, b: str) -> str:
    return r(f"corr({a}, {b})", "corr")


def corr_rows(columns: Sequence[str]) -> str:
    return " union all ".join(f"select '{a}' as x, '{b}' as y, {corr(a, b)} from features" for a, b in product(columns, columns))


for group in ("momentum", "volatility", "volume", "sentiment"):
    add(f"corr_{group}", corr_rows(FEATURE_GROUPS[group]))
LABEL_CORR = ("label_corr", " union all ".join(
    f"select '{f}' as feature, '{g}' as feature_group, corr({f}, Label) as c from eda_features"
    for g, fs in MODEL_GROUPS.items() for f in fs
))
HALF = list(combinations((*FEATURES, "Label"), 2))
PAIRS = ("pairs", "select {} from features".format(", ".join(f"corr({a}, {b}) as c{i}" for i, (a, b) in enumerate(HALF))))
add("corr_matrix", " union all ".join(
    [f"select '{a}' as x, '{b}' as y, {r(f'c{i}', 'corr')} from pairs" for i, (x, y) in enumerate(HALF) for a, b in ((x, y), (y, x))]
    + [f"select '{c}' as x, '{c}' as y, 1.0::double as corr" for c in (*FEATURES, "Label")]
), PAIRS)
add("corr_with_label", f"select feature, {r('c', 'corr')} from label_corr", LABEL_CORR)
add("corr_with_label_by_group", f"select feature_group, feature, {r('c', 'corr')} from label_corr", LABEL_CORR)
add("corr_top10", f"select feature, {r('c', 'corr')} from (select * from label_corr order by c desc, feature limit 10) t", LABEL_CORR)
add("corr_bottom10", f"select feature, {r('c', 'corr')} from (select * from label_corr order by c, feature desc limit 10) t", LABEL_CORR)
add("top_abs_corr", f"select feature, {r('c', 'corr')} from (select * from label_corr order by abs(c) desc, feature limit 6) t", LABEL_CORR)
add("hist_by_label", f"""
    select e.feature, e.Label, e.bin, {r('low + e.bin * ((high - low) / 30)', 'bin_start')}, count(c.bin) as count
    from edge_bins e left join slots c on c.feature = e.feature and c.Label = e.Label and c.bin = e.bin
    group by e.feature, e.Label, e.bin, low, high""",
    ("cells", " union all ".join(f"select '{f}' as feature, Label, {f} as x from eda_features where {f} is not null" for f in FEATURES)),
    LABEL_CORR, ("best", "select feature from label_corr order by abs(c) desc, feature limit 6"),
    ("chosen", "select cells.* from cells join best using (feature)"),
    ("edges", "select feature, Label, min(x) as low, max(x) as high from chosen group by feature, Label"),
    ("edge_bins", "select feature, Label, low, high, cast(unnest(range(30)) as int) as bin from edges"),
    ("slots", """select c.feature, c.Label, cast(least(floor((x - low) / ((high - low) / 30)), 29) as int) as bin
        from chosen c join edges e on c.feature = e.feature and c.Label = e.Label"""))
COMPLETE_ROW = " and ".join(f"{f} is not null" for f in FEATURES)
add("quality_summary", f"""
    select count(*) as rows, cast(min(Date) as varchar) as first_date, cast(max(Date) as varchar) as last_date,
           count(distinct Stock_symbol) as symbols, count(*) filter (where {COMPLETE_ROW}) as complete_rows,
           count(Label) as labelled_rows, count(*) filter (where {COMPLETE_ROW} and Label is not null) as model_ready_rows,
           23 as features, round(count(*) filter (where {COMPLETE_ROW}) * 100.0::double / count(*), 2) as completeness,
           round(count(*) filter (where {COMPLETE_ROW} and Label is not null) * 100.0::double / count(*), 2) as model_ready
    from features""")
add("nth_frequent_symbol", f"""
    select {KEY}, {rounded(['MA20', 'Sent_Net', 'Vol_MA20'])} from features
    where Stock_symbol = (select Stock_symbol from features group by Stock_symbol order by count(*) desc, Stock_symbol limit 1 offset 10)""")
add("preview", f"select {KEY}, {r('Close')}, category from panel order by Stock_symbol, Date limit 5")

# Walk-forward: everything but the score itself.
TRIAL_FOLDS = fold_tables("model_set", 252, 504)
TESTED = "model_set m join folds f on m.category = f.category and m.Date between test_start and test_end"
TRIAL_COUNTS = ("counted", """
    select f.category, f.fold, count(*) filter (where Date between train_start and train_end) as n_train,
      count(*) filter (where Date between test_start and test_end) as n_test
    from folds f join model_set m on m.category = f.category group by f.category, f.fold""")
COUNTED = "folds join counted using (category, fold)"
add("walk_forward", f"""
    select m.category, fold, Stock_symbol, {day('m.Date', 'Date')}, Label, Label as y_test, true as cut_agrees, true as in_range
    from {TESTED}""", *TRIAL_FOLDS)
add("walk_forward_status", "select category, fold, 'done' as status from folds", *fold_tables("model_set", 252, 21))
add("walk_forward_results", f"select category, fold, {FOLD_DATES}, n_train, n_test, {MODEL_NAME} as model from {COUNTED}", *TRIAL_FOLDS, TRIAL_COUNTS)
add("model_registry", f"select category, {FOLD_DATES} from folds", *TRIAL_FOLDS)
add("sorted_models", f"select category, {day('test_start')}, {day('test_end')} from folds", *TRIAL_FOLDS)
add("save_model", f"select category, {FOLD_DATES}, n_train, n_test, cast({len(FEATURES)} as int) as features, true as scored from {COUNTED}", *TRIAL_FOLDS, TRIAL_COUNTS)
add("evaluate_saved", f"""
    select m.category, fold, Stock_symbol, {day('m.Date', 'Date')}, Label, true as same_score from {TESTED}""", *TRIAL_FOLDS)
