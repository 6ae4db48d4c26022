"""Lookup values that must be exactly these for results to match.

FIXED VALUES — display names for wiki codes, namespaces, edit types,
language codes and project suffixes, plus the 88-row language dimension.
They are data, not logic: every entry is listed once, in its natural
order. Code that uses them lives in ``names.py`` and ``sources/dims.py``.
"""

# --- FIXED VALUES: curated wiki display names (89 codes) -------------------
WIKI_DISPLAY_NAMES = {
    "enwiki": "English Wikipedia",
    "simplewiki": "Simple English Wikipedia",
    "dewiki": "German Wikipedia",
    "frwiki": "French Wikipedia",
    "eswiki": "Spanish Wikipedia",
    "ptwiki": "Portuguese Wikipedia",
    "itwiki": "Italian Wikipedia",
    "ruwiki": "Russian Wikipedia",
    "ukwiki": "Ukrainian Wikipedia",
    "plwiki": "Polish Wikipedia",
    "nlwiki": "Dutch Wikipedia",
    "svwiki": "Swedish Wikipedia",
    "nowiki": "Norwegian (Bokmal) Wikipedia",
    "nnwiki": "Norwegian (Nynorsk) Wikipedia",
    "dawiki": "Danish Wikipedia",
    "fiwiki": "Finnish Wikipedia",
    "iswiki": "Icelandic Wikipedia",
    "cswiki": "Czech Wikipedia",
    "skwiki": "Slovak Wikipedia",
    "hrwiki": "Croatian Wikipedia",
    "srwiki": "Serbian Wikipedia",
    "slwiki": "Slovenian Wikipedia",
    "bgwiki": "Bulgarian Wikipedia",
    "rowiki": "Romanian Wikipedia",
    "huwiki": "Hungarian Wikipedia",
    "elwiki": "Greek Wikipedia",
    "trwiki": "Turkish Wikipedia",
    "hewiki": "Hebrew Wikipedia",
    "arwiki": "Arabic Wikipedia",
    "fawiki": "Persian Wikipedia",
    "urwiki": "Urdu Wikipedia",
    "hiwiki": "Hindi Wikipedia",
    "bnwiki": "Bengali Wikipedia",
    "tawiki": "Tamil Wikipedia",
    "tewiki": "Telugu Wikipedia",
    "mlwiki": "Malayalam Wikipedia",
    "knwiki": "Kannada Wikipedia",
    "mrwiki": "Marathi Wikipedia",
    "guwiki": "Gujarati Wikipedia",
    "pawiki": "Punjabi Wikipedia",
    "thwiki": "Thai Wikipedia",
    "viwiki": "Vietnamese Wikipedia",
    "idwiki": "Indonesian Wikipedia",
    "mswiki": "Malay Wikipedia",
    "tlwiki": "Tagalog Wikipedia",
    "jawiki": "Japanese Wikipedia",
    "kowiki": "Korean Wikipedia",
    "zhwiki": "Chinese Wikipedia",
    "zh_yuewiki": "Cantonese Wikipedia",
    "zh_minnanwiki": "Min Nan Wikipedia",
    "mnwiki": "Mongolian Wikipedia",
    "kkwiki": "Kazakh Wikipedia",
    "azwiki": "Azerbaijani Wikipedia",
    "kawiki": "Georgian Wikipedia",
    "hywiki": "Armenian Wikipedia",
    "swwiki": "Swahili Wikipedia",
    "yowiki": "Yoruba Wikipedia",
    "amwiki": "Amharic Wikipedia",
    "afwiki": "Afrikaans Wikipedia",
    "zuwiki": "Zulu Wikipedia",
    "euwiki": "Basque Wikipedia",
    "cawiki": "Catalan Wikipedia",
    "glwiki": "Galician Wikipedia",
    "cywiki": "Welsh Wikipedia",
    "gawiki": "Irish Wikipedia",
    "lawiki": "Latin Wikipedia",
    "eowiki": "Esperanto Wikipedia",
    "commonswiki": "Wikimedia Commons",
    "wikidatawiki": "Wikidata",
    "metawiki": "Wikimedia Meta",
    "mediawikiwiki": "MediaWiki Documentation",
    "specieswiki": "Wikispecies",
    "sourceswiki": "Wikisource (multilingual)",
    "foundationwiki": "Wikimedia Foundation site",
    "incubatorwiki": "Wikimedia Incubator",
    "outreachwiki": "Wikimedia Outreach",
    "loginwiki": "Wikimedia central login",
    "enwiktionary": "English Wiktionary",
    "frwiktionary": "French Wiktionary",
    "dewiktionary": "German Wiktionary",
    "ruwiktionary": "Russian Wiktionary",
    "itwikiquote": "Italian Wikiquote",
    "enwikinews": "English Wikinews",
    "frwikinews": "French Wikinews",
    "enwikiquote": "English Wikiquote",
    "frwikiquote": "French Wikiquote",
    "enwikisource": "English Wikisource",
    "frwikisource": "French Wikisource",
    "zhwikisource": "Chinese Wikisource",
}

# --- FIXED VALUES: namespace names (26 ids) --------------------------------
NAMESPACE_NAMES = {
    0: "Article",
    1: "Article talk",
    2: "User",
    3: "User talk",
    4: "Project",
    5: "Project talk",
    6: "File",
    7: "File talk",
    8: "MediaWiki",
    9: "MediaWiki talk",
    10: "Template",
    11: "Template talk",
    12: "Help",
    13: "Help talk",
    14: "Category",
    15: "Category talk",
    100: "Portal",
    101: "Portal talk",
    118: "Draft",
    119: "Draft talk",
    710: "TimedText",
    711: "TimedText talk",
    828: "Module",
    829: "Module talk",
    -1: "Special (virtual)",
    -2: "Media (virtual)",
}

# --- FIXED VALUES: edit type names (5 types) -------------------------------
EDIT_TYPE_NAMES = {
    "edit": "Edit (revision to existing page)",
    "new": "New page creation",
    "log": "Log entry (move, delete, protect, etc.)",
    "categorize": "Category membership change",
    "external": "External data update (e.g. Wikidata)",
}

# --- FIXED VALUES: language code names (213 distinct codes) ----------------
LANGUAGE_CODE_NAMES = {
    "en": "English", "simple": "Simple English", "de": "German",
    "fr": "French", "es": "Spanish", "pt": "Portuguese", "it": "Italian",
    "ru": "Russian", "uk": "Ukrainian", "pl": "Polish", "nl": "Dutch",
    "sv": "Swedish", "no": "Norwegian (Bokmal)", "nn": "Norwegian (Nynorsk)",
    "da": "Danish", "fi": "Finnish", "is": "Icelandic", "cs": "Czech",
    "sk": "Slovak", "hr": "Croatian", "sr": "Serbian", "sl": "Slovenian",
    "bg": "Bulgarian", "ro": "Romanian", "hu": "Hungarian", "el": "Greek",
    "tr": "Turkish", "he": "Hebrew", "ar": "Arabic", "fa": "Persian",
    "ur": "Urdu", "hi": "Hindi", "bn": "Bengali", "ta": "Tamil",
    "te": "Telugu", "ml": "Malayalam", "kn": "Kannada", "mr": "Marathi",
    "gu": "Gujarati", "pa": "Punjabi", "ne": "Nepali", "si": "Sinhala",
    "my": "Burmese", "th": "Thai", "vi": "Vietnamese", "id": "Indonesian",
    "ms": "Malay", "tl": "Tagalog", "ja": "Japanese", "ko": "Korean",
    "zh": "Chinese", "zh_yue": "Cantonese", "zh_minnan": "Min Nan",
    "mn": "Mongolian", "kk": "Kazakh", "az": "Azerbaijani", "ka": "Georgian",
    "hy": "Armenian", "sw": "Swahili", "yo": "Yoruba", "ha": "Hausa",
    "am": "Amharic", "af": "Afrikaans", "zu": "Zulu", "xh": "Xhosa",
    "eu": "Basque", "ca": "Catalan", "gl": "Galician", "cy": "Welsh",
    "ga": "Irish", "sc": "Sardinian", "la": "Latin", "eo": "Esperanto",
    "io": "Ido", "vo": "Volapuk", "ie": "Interlingue", "be": "Belarusian",
    "mk": "Macedonian", "bs": "Bosnian", "li": "Limburgish",
    "lb": "Luxembourgish", "fy": "West Frisian", "ku": "Kurdish",
    "ckb": "Central Kurdish (Sorani)", "ps": "Pashto", "tg": "Tajik",
    "jv": "Javanese", "min": "Minangkabau", "ce": "Chechen",
    "an": "Aragonese", "bcl": "Central Bicolano", "gpe": "Ghanaian Pidgin",
    "kcg": "Tyap", "sh": "Serbo-Croatian", "br": "Breton", "oc": "Occitan",
    "co": "Corsican", "wa": "Walloon", "rm": "Romansh", "fo": "Faroese",
    "sq": "Albanian", "lt": "Lithuanian", "lv": "Latvian", "et": "Estonian",
    "uz": "Uzbek", "ky": "Kyrgyz", "tk": "Turkmen", "sd": "Sindhi",
    "or": "Odia", "as": "Assamese", "km": "Khmer", "lo": "Lao", "ig": "Igbo",
    "wuu": "Wu", "hak": "Hakka", "tt": "Tatar", "ba": "Bashkir",
    "cv": "Chuvash", "sah": "Yakut", "kw": "Cornish", "gd": "Scottish Gaelic",
    "gv": "Manx", "se": "Northern Sami", "smn": "Inari Sami",
    "ny": "Chichewa", "lg": "Ganda", "rw": "Kinyarwanda", "rn": "Kirundi",
    "ts": "Tsonga", "tn": "Tswana", "ss": "Swati", "ve": "Venda",
    "st": "Sotho", "nso": "Northern Sotho", "ceb": "Cebuano", "war": "Waray",
    "nb": "Norwegian Bokmal", "nds": "Low German", "als": "Alemannic",
    "bar": "Bavarian", "frr": "North Frisian", "ksh": "Kolsch",
    "pms": "Piedmontese", "lmo": "Lombard", "vec": "Venetian",
    "nap": "Neapolitan", "scn": "Sicilian", "lij": "Ligurian",
    "pdc": "Pennsylvania German", "mt": "Maltese", "gan": "Gan Chinese",
    "bo": "Tibetan", "dz": "Dzongkha", "ti": "Tigrinya", "om": "Oromo",
    "so": "Somali", "sn": "Shona", "nv": "Navajo", "haw": "Hawaiian",
    "mi": "Maori", "sm": "Samoan", "to": "Tongan", "fj": "Fijian",
    "ty": "Tahitian", "qu": "Quechua", "gn": "Guarani", "ay": "Aymara",
    "ht": "Haitian Creole", "yi": "Yiddish", "lad": "Ladino",
    "iu": "Inuktitut", "kl": "Greenlandic", "ab": "Abkhazian",
    "os": "Ossetic", "ang": "Old English", "non": "Old Norse",
    "got": "Gothic", "cu": "Old Church Slavonic", "pi": "Pali",
    "sa": "Sanskrit", "tlh": "Klingon", "jbo": "Lojban", "kr": "Kanuri",
    "ks": "Kashmiri", "ee": "Ewe", "tw": "Twi", "wo": "Wolof", "ff": "Fulah",
    "bm": "Bambara", "akan": "Akan", "ak": "Akan", "tum": "Tumbuka",
    "lua": "Luba-Lulua", "kg": "Kongo", "ln": "Lingala", "umb": "Umbundu",
    "kab": "Kabyle", "shi": "Tachelhit", "ber": "Berber", "diq": "Zazaki",
    "lez": "Lezgian", "av": "Avaric", "bxr": "Buryat", "myv": "Erzya",
    "mdf": "Moksha", "krc": "Karachay-Balkar", "kv": "Komi", "udm": "Udmurt",
    "mhr": "Eastern Mari", "mrj": "Western Mari", "koi": "Komi-Permyak",
    "ady": "Adyghe", "kbd": "Kabardian",
}

# --- FIXED VALUES: project suffix names (8 suffixes) -----------------------
PROJECT_SUFFIX_NAMES = {
    "wiktionary": "Wiktionary",
    "wikiquote": "Wikiquote",
    "wikibooks": "Wikibooks",
    "wikisource": "Wikisource",
    "wikinews": "Wikinews",
    "wikiversity": "Wikiversity",
    "wikivoyage": "Wikivoyage",
    "wiki": "Wikipedia",
}

# --- FIXED VALUES: language dimension (88 rows) ----------------------------
# wiki,language,continent,region,primary_country
LANGUAGE_DIMENSION_CSV = """\
enwiki,English,Multiple,Global,United States
simplewiki,Simple English,Multiple,Global,United States
dewiki,German,Europe,EMEA,Germany
frwiki,French,Europe,EMEA,France
eswiki,Spanish,Multiple,Global,Spain
ptwiki,Portuguese,South America,Americas,Brazil
itwiki,Italian,Europe,EMEA,Italy
ruwiki,Russian,Europe,EMEA,Russia
ukwiki,Ukrainian,Europe,EMEA,Ukraine
plwiki,Polish,Europe,EMEA,Poland
nlwiki,Dutch,Europe,EMEA,Netherlands
svwiki,Swedish,Europe,EMEA,Sweden
nowiki,Norwegian (Bokmal),Europe,EMEA,Norway
nnwiki,Norwegian (Nynorsk),Europe,EMEA,Norway
dawiki,Danish,Europe,EMEA,Denmark
fiwiki,Finnish,Europe,EMEA,Finland
iswiki,Icelandic,Europe,EMEA,Iceland
cswiki,Czech,Europe,EMEA,Czech Republic
skwiki,Slovak,Europe,EMEA,Slovakia
hrwiki,Croatian,Europe,EMEA,Croatia
srwiki,Serbian,Europe,EMEA,Serbia
slwiki,Slovenian,Europe,EMEA,Slovenia
bgwiki,Bulgarian,Europe,EMEA,Bulgaria
rowiki,Romanian,Europe,EMEA,Romania
huwiki,Hungarian,Europe,EMEA,Hungary
elwiki,Greek,Europe,EMEA,Greece
trwiki,Turkish,Asia,EMEA,Turkey
hewiki,Hebrew,Asia,EMEA,Israel
arwiki,Arabic,Multiple,EMEA,Saudi Arabia
fawiki,Persian,Asia,EMEA,Iran
urwiki,Urdu,Asia,APAC,Pakistan
hiwiki,Hindi,Asia,APAC,India
bnwiki,Bengali,Asia,APAC,Bangladesh
tawiki,Tamil,Asia,APAC,India
tewiki,Telugu,Asia,APAC,India
mlwiki,Malayalam,Asia,APAC,India
knwiki,Kannada,Asia,APAC,India
mrwiki,Marathi,Asia,APAC,India
guwiki,Gujarati,Asia,APAC,India
pawiki,Punjabi,Asia,APAC,India
nepwiki,Nepali,Asia,APAC,Nepal
newwiki,Newari,Asia,APAC,Nepal
siwiki,Sinhala,Asia,APAC,Sri Lanka
mywiki,Burmese,Asia,APAC,Myanmar
thwiki,Thai,Asia,APAC,Thailand
viwiki,Vietnamese,Asia,APAC,Vietnam
idwiki,Indonesian,Asia,APAC,Indonesia
mswiki,Malay,Asia,APAC,Malaysia
tlwiki,Tagalog,Asia,APAC,Philippines
jawiki,Japanese,Asia,APAC,Japan
kowiki,Korean,Asia,APAC,South Korea
zhwiki,Chinese,Asia,APAC,China
zh_yuewiki,Cantonese,Asia,APAC,Hong Kong
zh_minnanwiki,Min Nan,Asia,APAC,Taiwan
mnwiki,Mongolian,Asia,APAC,Mongolia
kkwiki,Kazakh,Asia,APAC,Kazakhstan
uzwiki,Uzbek,Asia,APAC,Uzbekistan
azwiki,Azerbaijani,Asia,EMEA,Azerbaijan
kawiki,Georgian,Asia,EMEA,Georgia
hywiki,Armenian,Asia,EMEA,Armenia
swwiki,Swahili,Africa,EMEA,Kenya
yowiki,Yoruba,Africa,EMEA,Nigeria
hawiki,Hausa,Africa,EMEA,Nigeria
amwiki,Amharic,Africa,EMEA,Ethiopia
afwiki,Afrikaans,Africa,EMEA,South Africa
zuwiki,Zulu,Africa,EMEA,South Africa
xhwiki,Xhosa,Africa,EMEA,South Africa
euwiki,Basque,Europe,EMEA,Spain
cawiki,Catalan,Europe,EMEA,Spain
glwiki,Galician,Europe,EMEA,Spain
cywiki,Welsh,Europe,EMEA,United Kingdom
gawiki,Irish,Europe,EMEA,Ireland
scwiki,Sardinian,Europe,EMEA,Italy
lawiki,Latin,Europe,EMEA,Vatican
eowiki,Esperanto,Multiple,Global,(Constructed)
iowiki,Ido,Multiple,Global,(Constructed)
vowiki,Volapuk,Multiple,Global,(Constructed)
iewiki,Interlingue,Multiple,Global,(Constructed)
commonswiki,(Multimedia commons),Multiple,Global,(Wikimedia project)
wikidatawiki,(Wikidata),Multiple,Global,(Wikimedia project)
metawiki,(Meta coordination),Multiple,Global,(Wikimedia project)
mediawikiwiki,(MediaWiki software docs),Multiple,Global,(Wikimedia project)
specieswiki,(Species taxonomy),Multiple,Global,(Wikimedia project)
sourceswiki,(Wikisource multilingual),Multiple,Global,(Wikimedia project)
foundationwiki,(Wikimedia Foundation),Multiple,Global,(Wikimedia project)
incubatorwiki,(Incubator),Multiple,Global,(Wikimedia project)
outreachwiki,(Outreach),Multiple,Global,(Wikimedia project)
loginwiki,(Central login),Multiple,Global,(Wikimedia project)
"""

# --- FIXED VALUES: feed line prefix and misc constants ---------------------
FEED_DATA_PREFIX = "data: "
COMMENT_MAX_CHARS = 240
UNKNOWN_LABEL = "(unknown)"
DEFAULT_PICKER_LABEL = "English Wikipedia"
LONG_MAX = 9223372036854775807
ROW_KEY_DIGITS = 20
