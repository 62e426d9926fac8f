"""Default word lists, patterns and look-up tables.

Fixed values: results depend on them, so they are stated as they must be. Every operator takes its list as
an argument; these are only the defaults.
"""

from __future__ import annotations

NEWS_STOP_WORDS = ("said says according reported reports news story article yesterday today tomorrow "
                   "monday tuesday wednesday thursday friday saturday sunday").split()
URGENCY = "breaking urgent alert emergency crisis immediate".split()
OPINION = "believe think opinion view perspective argue".split()
FACTUAL = "according reported stated confirmed data statistics".split()
TIME_WORDS = "today yesterday tomorrow recently now current".split()
NEWS_LEXICONS = {"urgency": URGENCY, "opinion": OPINION, "factual": FACTUAL, "time": TIME_WORDS}
BREAKING = "breaking urgent alert emergency crisis developing live update flash bulletin".split()

SEARCH_POSITIVE = ("success good great excellent positive boost growth increase breakthrough achievement win wins "
                   "victory soar rise improve better best amazing wonderful fantastic outstanding record launch "
                   "expansion profit gain advance progress").split()
SEARCH_NEGATIVE = ("problem issue bad worse worst negative decline fall drop crisis failure lose loss defeat scandal "
                   "controversy concern worry risk danger threat cut reduce layoff fire quit resign crash collapse "
                   "struggle difficult").split()
SHORT_POSITIVE = "good great excellent amazing wonderful fantastic positive success".split()
SHORT_NEGATIVE = "bad terrible awful horrible negative fail disaster crisis".split()
BROWSE_POSITIVE = ("success win achievement breakthrough celebrate victory improve excellent outstanding "
                   "triumph").split()
BROWSE_NEGATIVE = "crisis failure problem decline loss concern trouble difficult worse threat".split()

EMOTIONAL_POSITIVE = ("excellent outstanding remarkable extraordinary brilliant successful triumphant victorious "
                      "breakthrough innovative").split()
EMOTIONAL_NEGATIVE = ("terrible awful disastrous catastrophic horrible failed defeated crisis scandal "
                      "controversy").split()
POLITICAL = {
    "left": ["progressive", "liberal", "socialist", "democratic", "inclusive", "diversity", "equality",
             "climate change", "social justice"],
    "right": ["conservative", "traditional", "patriotic", "security", "business", "free market", "constitutional",
              "law and order", "fiscal responsibility"],
    "neutral": ["reported", "stated", "according to", "sources say", "officials confirm"],
}
ATTRIBUTION_PATTERNS = [
    "according to",
    "sources? (say|said|tell|told)",
    "officials? (say|said|confirm|confirmed)",
    "experts? (say|said|believe|think)",
    "(he|she|they) (said|stated|reported|claimed)",
    "quoted|citing|referenced",
]
BIAS_OPINION = "think believe feel opinion view perspective".split()
BIAS_FACT = "data evidence study research statistics findings".split()

CATEGORY_RULES_LONG = [
    ("politics", ["trump", "president", "tariff", "trade war", "government", "policy", "election", "administration",
                  "political", "congress", "senate"]),
    ("tech", ["technology", "ai", "artificial intelligence", "chip", "apple", "google", "microsoft", "tech",
              "software", "digital"]),
    ("sport", ["football", "soccer", "basketball", "sport", "match", "player", "team", "game", "championship"]),
    ("entertainment", ["movie", "film", "music", "celebrity", "entertainment", "actor", "actress", "show",
                       "concert"]),
]
CATEGORY_RULES_SHORT = [
    ("politics", ["trump", "president", "government", "policy", "politics"]),
    ("tech", ["technology", "ai", "tech", "chip", "apple"]),
    ("sport", ["sport", "football", "game", "team", "match"]),
    ("entertainment", ["movie", "music", "entertainment", "celebrity"]),
]
OVERRIDE_RULES = [
    ("politics", ["trump", "tariff", "trade war", "government", "policy", "election", "president", "administration",
                  "political"]),
    ("tech", ["ai", "artificial intelligence", "technology", "chip", "apple", "google", "microsoft", "tech"]),
    ("sport", ["football", "soccer", "sport", "match", "player", "team", "game"]),
]
RATIONALE_WORDS = {
    "tech": ["technology", "ai", "digital", "software", "computer"],
    "politics": ["government", "policy", "election", "political", "minister"],
    "sport": ["football", "match", "team", "player", "game"],
    "business": ["company", "market", "financial", "economic", "profit"],
    "entertainment": ["film", "music", "celebrity", "show", "movie"],
}
TRANSITIONS = ("however therefore moreover furthermore additionally meanwhile consequently thus hence also "
               "then").split()

COMMAND_WORDS = "show me find get articles news the a an".split()
SEARCH_STOP_WORDS = ("a an the and or but in on at to for of with by is are was were be been being have has had do "
                     "does did will would could should").split()

THEMES = {
    "en": {"politics": ["government", "election", "president", "parliament", "congress"],
           "business": ["company", "market", "stock", "economy", "finance"],
           "sports": ["game", "match", "team", "player", "championship"],
           "technology": ["software", "computer", "internet", "digital", "tech"]},
    "es": {"politics": ["gobierno", "elección", "presidente", "parlamento", "congreso"],
           "business": ["empresa", "mercado", "economía", "finanzas", "negocio"],
           "sports": ["partido", "equipo", "jugador", "fútbol", "deporte"],
           "technology": ["tecnología", "computadora", "internet", "digital"]},
    "fr": {"politics": ["gouvernement", "élection", "président", "parlement"],
           "business": ["entreprise", "marché", "économie", "finance"],
           "sports": ["match", "équipe", "joueur", "football", "sport"],
           "technology": ["technologie", "ordinateur", "internet", "numérique"]},
}
FAMILIES = {"en": "Germanic", "de": "Germanic", "es": "Romance", "fr": "Romance", "it": "Romance", "pt": "Romance",
            "ru": "Slavic", "ja": "Japonic", "ko": "Koreanic", "zh": "Sino-Tibetan", "ar": "Semitic",
            "hi": "Indo-Aryan"}
REGIONS = {
    "en_US": ["dollar", "america", "usa", "american", "washington", "congress", "nfl", "nba"],
    "en_UK": ["pound", "britain", "british", "london", "parliament", "premier league", "bbc"],
    "en_AU": ["australia", "australian", "sydney", "melbourne", "afl", "cricket"],
    "en_CA": ["canada", "canadian", "toronto", "vancouver", "hockey", "quebec"],
    "es_ES": ["españa", "español", "madrid", "barcelona", "euro", "la liga"],
    "es_MX": ["méxico", "mexicano", "peso", "guadalajara", "azteca"],
    "es_AR": ["argentina", "argentino", "buenos aires", "peso", "tango"],
    "fr_FR": ["france", "français", "paris", "euro", "marseille", "ligue 1"],
    "fr_CA": ["canada", "québec", "montreal", "canadian", "hockey"],
    "de_DE": ["deutschland", "deutsch", "berlin", "münchen", "bundesliga"],
    "de_AT": ["österreich", "wien", "salzburg", "austrian"],
    "de_CH": ["schweiz", "zürich", "geneva", "swiss", "franken"],
}
CULTURE_MARKERS = {
    "western": {"values": ["democracy", "freedom", "individual rights", "capitalism", "innovation"],
                "institutions": ["nato", "eu", "g7", "world bank", "imf"],
                "perspectives": ["human rights", "rule of law", "market economy"]},
    "eastern": {"values": ["collective harmony", "social stability", "family values", "tradition"],
                "institutions": ["brics", "sco", "asean", "silk road"],
                "perspectives": ["social order", "economic development", "sovereignty"]},
    "middle_eastern": {"values": ["religious tradition", "family honor", "hospitality", "community"],
                       "institutions": ["arab league", "gcc", "oic"],
                       "perspectives": ["religious values", "regional stability", "cultural identity"]},
    "african": {"values": ["ubuntu", "community solidarity", "ancestral wisdom", "unity"],
                "institutions": ["african union", "ecowas", "sadc"],
                "perspectives": ["pan-africanism", "development", "decolonization"]},
    "latin_american": {"values": ["familia", "personalismo", "simpatía", "machismo"],
                       "institutions": ["mercosur", "oas", "celac", "unasur"],
                       "perspectives": ["regional integration", "social justice", "cultural identity"]},
}
CULTURES_OF = {"en": ["western"], "es": ["western", "latin_american"], "fr": ["western", "african"],
               "de": ["western"], "it": ["western"], "pt": ["western", "latin_american", "african"],
               "ru": ["eastern"], "zh": ["eastern"], "ja": ["eastern"], "ko": ["eastern"],
               "ar": ["middle_eastern", "african"], "hi": ["eastern"], "tr": ["middle_eastern", "eastern"]}
CONFLICTS = {
    "individualism_vs_collectivism": {
        "individualism": ["individual rights", "personal freedom", "self-reliance"],
        "collectivism": ["collective harmony", "community", "social stability"]},
    "western_vs_eastern": {
        "western": ["democracy", "capitalism", "secularism"],
        "eastern": ["tradition", "hierarchy", "spiritual values"]},
}
BRIDGES = ["peace", "prosperity", "education", "health", "family"]

EXPECTED_LETTERS = {"es": "áéíóúüñ¿¡", "fr": "àâäéèêëîïôöùûüÿç", "de": "äöüß", "it": "àèéìíîòóù",
                    "pt": "ãâáàçéêíóôõú", "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "ja": "ひらがなカタカナ",
                    "ko": "한글", "zh": "中文", "ar": "العربية"}
NON_LATIN = ["ru", "ja", "ko", "zh", "ar"]
ALWAYS_PRESERVED = ["covid", "nasa", "eu", "un", "usa", "uk"]
CURRENCIES = {
    ("en", "es"): {"dollar": "dólar", "dollars": "dólares"},
    ("en", "fr"): {"dollar": "dollar", "dollars": "dollars"},
    ("en", "de"): {"dollar": "Dollar", "dollars": "Dollar"},
    ("es", "en"): {"peso": "peso", "pesos": "pesos"},
    ("fr", "en"): {"euro": "euro", "euros": "euros"},
    ("de", "en"): {"euro": "euro", "euros": "euros"},
}
ADAPTATIONS = {
    ("en", "es"): {"football": "fútbol americano", "soccer": "fútbol", "mom": "mamá", "dad": "papá"},
    ("en", "fr"): {"weekend": "fin de semaine", "email": "courriel", "parking": "stationnement"},
    ("en", "de"): {"mobile phone": "Handy", "cell phone": "Handy", "internet": "Internet"},
}
UNITS = {"feet": "meters", "miles": "kilometers", "pounds": "kilograms"}

LANGUAGE_NAMES = {
    "en": "English", "es": "Spanish", "fr": "French", "de": "German", "it": "Italian", "pt": "Portuguese",
    "ru": "Russian", "ja": "Japanese", "ko": "Korean", "zh": "Chinese", "ar": "Arabic", "hi": "Hindi",
    "nl": "Dutch", "sv": "Swedish", "da": "Danish", "no": "Norwegian", "fi": "Finnish", "pl": "Polish",
    "tr": "Turkish", "th": "Thai", "vi": "Vietnamese",
}

# (type, pattern with two groups, pattern that must occur for a match). A run of words is written
# \w(?:[\w\s]*\w)? so that long runs need no recursion in the matcher.
RELATION_PATTERNS = [
    ("CEO_OF", r"(\w(?:[\w\s]*\w)?)\s+(?:is\s+)?(?:the\s+)?CEO\s+of\s+([A-Z][a-zA-Z\s&]+)", r"ceo\s+of\s"),
    ("CEO_OF", r"CEO\s+(\w(?:[\w\s]*\w)?)\s+of\s+([A-Z][a-zA-Z\s&]+)", r"ceo\s"),
    ("CEO_OF", r"([A-Z][a-zA-Z\s&]+)\s+CEO\s+(\w(?:[\w\s]*\w)?)", r"\sceo\s"),
    ("WORKS_FOR", r"(\w(?:[\w\s]*\w)?)\s+works?\s+(?:for|at)\s+([A-Z][a-zA-Z\s&]+)", r"\sworks?\s+(?:for|at)\s"),
    ("WORKS_FOR", r"(\w(?:[\w\s]*\w)?)\s+(?:employee|staff|member)\s+(?:of|at)\s+([A-Z][a-zA-Z\s&]+)",
     r"\s(?:employee|staff|member)\s+(?:of|at)\s"),
    ("LOCATED_IN", r"([A-Z][a-zA-Z\s&]+)\s+(?:in|located\s+in|based\s+in)\s+([A-Z][a-zA-Z\s,]+)", r"\sin\s"),
    ("LOCATED_IN", r"([A-Z][a-zA-Z\s&]+),?\s+([A-Z][a-zA-Z]+(?:,\s+[A-Z]{2})?)", r"\w"),
    ("ACQUIRED_BY", r"([A-Z][a-zA-Z\s&]+)\s+(?:was\s+)?acquired\s+by\s+([A-Z][a-zA-Z\s&]+)", r"\sacquired\s+by\s"),
    ("ACQUIRED_BY", r"([A-Z][a-zA-Z\s&]+)\s+purchase[ds]\s+([A-Z][a-zA-Z\s&]+)", r"\spurchase[ds]\s"),
    ("PARTNERED_WITH", r"([A-Z][a-zA-Z\s&]+)\s+partner(?:ed|ship)?\s+with\s+([A-Z][a-zA-Z\s&]+)",
     r"\spartner(?:ed|ship)?\s+with\s"),
    ("PARTNERED_WITH", r"([A-Z][a-zA-Z\s&]+)\s+(?:and|&)\s+([A-Z][a-zA-Z\s&]+)\s+(?:announced|signed|agreed)",
     r"\s(?:announced|signed|agreed)"),
]
LABEL_ALIASES = {"PER": "PERSON", "ORGANIZATION": "ORG", "LOCATION": "LOC", "GEOPOLITICAL": "GPE"}
LEAD_WORDS = ["ceo", "chief", "president", "founder"]
STAFF_WORDS = ["employee", "works", "staff"]

INTENTS = {
    "search_articles": {
        "keywords": ["find", "search", "show", "get", "articles", "news", "about", "containing"],
        "examples": ["find articles about technology", "search for news about climate change",
                     "show me articles containing covid", "get news about artificial intelligence"]},
    "analyze_sentiment": {
        "keywords": ["sentiment", "emotion", "positive", "negative", "feeling", "mood", "tone"],
        "examples": ["what is the sentiment about elections", "analyze emotions in sports news",
                     "show positive news this week", "how negative is political coverage"]},
    "classify_content": {
        "keywords": ["classify", "category", "type", "categorize", "what kind", "what type"],
        "examples": ["what category is this article", "classify these news pieces", "what type of news is this",
                     "categorize by topic"]},
    "summarize_text": {
        "keywords": ["summarize", "summary", "brief", "overview", "key points", "main points"],
        "examples": ["summarize this article", "give me a brief overview", "what are the key points",
                     "create a summary of recent news"]},
    "extract_entities": {
        "keywords": ["who", "what companies", "organizations", "people", "locations", "extract", "entities"],
        "examples": ["who are the people mentioned", "what companies are involved", "extract all locations",
                     "find organizations in this text"]},
    "get_insights": {
        "keywords": ["trends", "insights", "patterns", "analysis", "analytics", "tell me about"],
        "examples": ["what are the trends in tech news", "give me insights about market coverage",
                     "analyze patterns in political reporting", "what insights can you provide"]},
    "compare_sources": {
        "keywords": ["compare", "comparison", "between", "across", "different", "versus", "cross"],
        "examples": ["compare coverage between english and spanish", "how do different sources cover this topic",
                     "compare sentiment across languages", "cross-language analysis"]},
    "trend_analysis": {
        "keywords": ["trends", "over time", "evolution", "changed", "temporal", "track", "history"],
        "examples": ["show trends over the past month", "how has coverage changed over time",
                     "track sentiment evolution", "temporal analysis of topics"]},
    "export_results": {
        "keywords": ["export", "download", "save", "generate", "report", "csv", "file"],
        "examples": ["export these results to csv", "generate a report", "download the analysis", "save this data"]},
    "get_help": {
        "keywords": ["help", "how", "what can", "capabilities", "assistance", "guide"],
        "examples": ["what can you do", "help me with analysis", "how do I search for articles",
                     "what are your capabilities"]},
}
NUMBER_WORDS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"]
FOLLOW_UP_WORDS = ["another", "different", "more", "other", "new", "additional"]
FOLLOW_UP_CUES = ["also", "and", "additionally", "furthermore", "moreover"]
QUERY_CATEGORIES = ["politics", "technology", "tech", "business", "sports", "entertainment", "health", "science"]
QUERY_SENTIMENTS = {
    "positive": ["positive", "good", "happy", "excellent", "great", "successful"],
    "negative": ["negative", "bad", "sad", "terrible", "crisis", "problem"],
    "neutral": ["neutral", "objective", "factual"],
}
TIME_FILTERS = [("recent", ["today", "recent", "latest"]), ("week", ["this week", "weekly"]),
                ("month", ["this month", "monthly"])]
HEADLINE_VERBS = ["announces", "reveals", "launches", "introduces", "expands", "develops"]

GRADE_THRESHOLDS = {"classification_accuracy": 0.85, "sentiment_correlation": 0.6, "ner_f1": 0.8,
                    "topic_coherence": 0.4, "rouge": 0.3, "bleu": 0.4, "intent_accuracy": 0.8,
                    "query_success": 0.9}

# Short valence list for the default sentiment lexicon: word -> valence on the -4..4 scale.
VALENCE = {w: 2.0 for w in SEARCH_POSITIVE} | {w: -2.0 for w in SEARCH_NEGATIVE} | {
    w: 3.0 for w in ("excellent", "amazing", "wonderful", "fantastic", "outstanding", "best")} | {
    w: -3.0 for w in ("terrible", "awful", "horrible", "worst", "disaster")}
NEGATIONS = ("not no never none nobody nothing neither nor cannot can't won't don't doesn't didn't isn't aren't "
             "wasn't weren't without").split()
