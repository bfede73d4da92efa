"""Word lists whose members decide results. Plain text, natural order."""

from __future__ import annotations


def _lines(text: str) -> list[str]:
    return [line.strip() for line in text.strip().splitlines()]


def _terms(text: str) -> list[str]:
    return [term.strip() for term in text.replace("\n", " ").split(",") if term.strip()]


# Trading platform names that make a comment relevant.
PLATFORMS = _terms("""
robinhood, webull, td ameritrade, thinkorswim, fidelity, schwab, etrade, interactive brokers, ibkr, tastyworks,
merrill edge, vanguard, sofi, public, moomoo, tradingview, m1 finance, tradestation, tda, futu, tiger brokers,
firstrade, ally invest, degiro, trading212, plus500, etoro, saxo, questrade, wealthsimple, ib, tasty,
think or swim, tos, ameritrade, charles schwab, coinbase, binance, kraken, gemini, ftx, kucoin, crypto.com,
bitstamp, huobi, blockfi, celsius, voyager, metamask, trust wallet, trading app, brokerage, trading platform, broker
""")

# Words that mark an opinion.
OPINION_WORDS = _terms("""
experience, review, thoughts, feedback, opinions, recommendation, suggest, avoid, stay away, prefer, better than,
worse than, compared to, versus, good, bad, terrible, excellent, amazing, awful, horrible, great, recommend,
worth it, not worth, disappointed, satisfied, impressed, frustrating, reliable, unreliable, convenient,
inconvenient, user-friendly, complicated, straightforward, easy to use, difficult, learning curve, pros, cons,
advantages, disadvantages, like, dislike, hate, love, rating, star, rank, compare, comparison, alternative,
switch, best, worst, top, overrated, underrated, value for money
""")

# Topic words.
TOPICS = {
    "fees": _terms("""
fee, commission, pricing, cost, expensive, cheap, affordable, subscription, monthly fee, annual fee,
transaction fee, hidden charges, price, pricing plan
"""),
    "trading": _terms("""
options, stock, stocks, futures, forex, crypto, etf, mutual fund, bonds, derivatives, margin, leverage,
short selling, fractional shares, pre-market, after-hours, extended hours, limit order, stop loss
"""),
    "ux": _terms("""
interface, dashboard, ui, ux, user interface, intuitive, clunky, buggy, responsive, lag, glitch, crash, latency,
loading time, navigation
"""),
    "tools": _terms("""
chart, charting, analysis, research, screener, scanner, alert, notification, watchlist, portfolio, tracking,
news feed, indicator, technical analysis, fundamental analysis, educational, tutorial, mobile app, desktop
"""),
    "support": _terms("""
customer service, support, help, response time, customer care, assistance, live chat, phone support,
email support, onboarding, account opening
"""),
}

# Communities to keep.
COMMUNITIES = _terms("""
tigerbrokers_official, webull, TigerBrokers, singaporefi, ibkr, moomoo_official, Etoro, RobinHood, plus500, Fidelity,
thinkorswim, InteractiveBrokers, TradeStation, CharlesSchwab, vanguard, merrilledge, etrade, tdameritrade, Trading212,
RevolutTrading, FreetradeApp, Wealthsimple
""")

# Words a comment must hold one of to be returned by a search.
SEARCH_FILTER_WORDS = ["good", "great", "bad", "terrible"]

# Placeholders for missing fields.
NO_POST_TEXT = "[No text content]"
NO_AUTHOR_TEXT = "[No content written by the author]"
UNKNOWN_AUTHOR = "unknown"

# English stop words.
STOPWORDS = """
a about above after again against ain all am an and any are aren aren't as at be because been before being below
between both but by can couldn couldn't d did didn didn't do does doesn doesn't doing don don't down during each few
for from further had hadn hadn't has hasn hasn't have haven haven't having he he'd he'll he's her here hers herself him
himself his how i i'd i'll i'm i've if in into is isn isn't it it'd it'll it's its itself just ll m ma me mightn
mightn't more most mustn mustn't my myself needn needn't no nor not now o of off on once only or other our ours
ourselves out over own re s same shan shan't she she'd she'll she's should should've shouldn shouldn't so some such t
than that that'll the their theirs them themselves then there these they they'd they'll they're they've this those
through to too under until up ve very was wasn wasn't we we'd we'll we're we've were weren weren't what when where which
while who whom why will with won won't wouldn wouldn't y you you'd you'll you're you've your yours yourself yourselves
""".split()

# Sets of equivalent search words.
SYNONYMS = [
    _terms(line)
    for line in _lines("""
ui, user interface
broker, brokerage, trading firm
buy, purchase, acquire
sell, offload, liquidate
trading, investing, buying and selling
account, profile, user account
platform, system, dashboard, application
bonds, fixed income, debt securities
funds, mutual funds, etfs
performance, returns, gains, profits
losses, deficits, negative returns
api, application programming interface, integration
market, exchange, trading venue
order, transaction, trade
chart, graph, price movement
risk, volatility, exposure
support, customer service, helpdesk
""")
]

# Tokens that are left over from links.
LINK_TOKENS = ["https", "http", "com", "www"]

# Words that turn the sentiment of what follows (published rule-based sentiment model).
NEGATIONS = """
ain't aint aren't arent can't cant cannot couldn't couldnt daren't darent didn't didnt doesn't doesnt don't dont hadn't
hadnt hasn't hasnt haven't havent isn't isnt mightn't mightnt mustn't mustnt needn't neednt neither never no none nope
nor not nothing nowhere oughtn't oughtnt shan't shant shouldn't shouldnt uh-uh wasn't wasnt weren't werent without
won't wont wouldn't wouldnt rarely seldom despite
""".split()

# Degree adverbs and the sign of their effect (published rule-based sentiment model).
BOOSTERS = {
    **dict.fromkeys(
        """
absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely especially
exceptionally extremely fabulously flipping frickin fricking fully greatly hella highly hugely incredibly intensely
majorly more most particularly purely quite really remarkably so substantially thoroughly totally tremendously
unbelievably unusually utterly very
""".split(),
        0.293,
    ),
    **dict.fromkeys(
        """
almost barely hardly kinda less little marginally occasionally partly scarcely slightly somewhat sorta
""".split(),
        -0.293,
    ),
}

# Starter lexicon of our own: words of mild, clear and strong opinion, one, two or three up or down.
# Callers bring their own table for real work.
STARTER_LEXICON = {
    **dict.fromkeys(["recommend", "easy", "helpful", "reliable"], 1.0),
    **dict.fromkeys(["good", "happy", "satisfied", "impressed"], 2.0),
    **dict.fromkeys(["great", "best", "love", "excellent", "amazing"], 3.0),
    **dict.fromkeys(["avoid", "crash", "frustrating", "disappointed"], -1.0),
    **dict.fromkeys(["bad", "trash", "stupid", "idiot", "worthless"], -2.0),
    **dict.fromkeys(["terrible", "awful", "horrible", "hate", "worst", "scam", "disgusting", "pathetic"], -3.0),
}

# Irregular noun plurals of our own choice; regular ones follow suffix rules.
IRREGULAR_PLURALS = {
    "men": "man", "women": "woman", "children": "child", "feet": "foot", "teeth": "tooth", "mice": "mouse", "geese": "goose", "people": "people",
    "lives": "life", "wives": "wife", "knives": "knife", "leaves": "leaf", "indices": "index", "analyses": "analysis",
}
