"""Word lists that decide results. Fixed values, in one place; every function takes them as parameters, so other lists can be used."""

# Public suffixes of two labels.
PUBLIC_SUFFIXES = ("co.jp", "or.jp", "ne.jp", "go.jp", "ac.jp", "co.uk", "org.uk", "gov.uk", "ac.uk")

# What looks like a top-level domain but ends a file name.
ASSET_TLDS = ("jpg", "jpeg", "png", "gif", "webp", "svg", "bmp", "ico", "avif", "mp4", "webm", "mov", "pdf", "js", "css", "woff", "woff2", "ttf", "eot")

# Fragments of e-mail domains that are never real.
BAD_EMAIL_HOSTS = (
    "mockconsole.prototype", "prototype.render", "prototype.read", "rendertostring", "template.com", "template.net", "template.org",
    "template.ae", "template.co.jp", "group.calendar.google.com", "example.jp", "example.co.jp", "example.com", "example.org",
    "example.net", "gmaii.com", "gmai.com", "gmail.jp", "xyzmail.com", "48g9-.bybgnptut", "sample.com", "sample.co.jp", "site.com.br",
    "mysite.com", "mysite.co.jp", "eksempel.dk", "sentry.io", "sentry.wixpress.com", "sentry-next.wixpress.com",
)

# Local parts that are ignored.
IGNORED_LOCALS = ("x", "xx", "xxx", "name", "test", "example", "sample", "yourname", "youremail", "email", "noreply", "no-reply", "donotreply", "do-not-reply")

# Placeholders in local parts, in domains, and stems of them.
PLACEHOLDER_LOCALS = ("aaa", "aaaa", "aaaaa", "dummy", "example", "hogehoge", "hoge", "name", "sample", "test", "xxx", "xxxx", "xxxxx", "xxxxxx", "yourdomain", "yourdmain")
PLACEHOLDER_DOMAINS = ("aaa", "dummy", "email", "example", "sample", "test", "yourdomain", "yourdmain")
PLACEHOLDER_STEMS = ("dummy", "email", "example", "name", "sample", "test")

# Local parts that come first.
PRIORITY_LOCALS = (
    "contact", "customer", "hello", "help", "hr", "info", "inquiry", "office", "privacy", "pr", "press", "recruit", "recruiting",
    "sales", "service", "support", "saiyo", "soumu", "kojinjoho",
)

# Domains of free mail.
FREE_MAIL = (
    "aol.com", "gmail.com", "googlemail.com", "hotmail.com", "icloud.com", "live.com", "mac.com", "me.com", "msn.com", "outlook.com",
    "pm.me", "proton.me", "protonmail.com", "yahoo.co.jp", "yahoo.com", "yahoo.com.br",
)

# Local parts dropped when the domain is not the site's.
OFFSITE_DROPPED = ("found", "posted", "profile", "webmaster", "website")

# Hosts that are no company's own site (contained, or at the end).
BLOCKED_HOST_PARTS = (
    "google.", "gstatic.", "googleusercontent.", "googleapis.", "g.page", "goo.gl", "localguideprogram", "maps.app",
    "hotelbeds.com", "worldota.net", "googlesyndication.com", "p.fih.io", "staticontent.com", "stays.net",
)
BLOCKED_HOST_ENDS = (
    "aenabrasil.com.br", "anota.ai", "app.cardapioweb.com", "api.whatsapp.com", "bigd.im", "booking.com", "bluepillow.com", "carsensor.net",
    "cartorionobrasil.com.br", "company-information.service.gov.uk", "descubraalagoas.com.br", "eitamenu.com", "encurtador.com.br", "fb.me",
    "getyourguide.com", "giatamedia.com", "goo-net.com", "tripadvisor.com", "expedia.com", "hoteis.com", "hotels.com", "ifood.com.br",
    "instagran.com", "instadelivery.com.br", "linktr.ee", "lojalocal.com", "me-qr.com", "menudino.com", "goomer.app", "ola.click",
    "decolar.com", "parceiromagalu.com.br", "pedido.anota.ai", "rvpedidos.com.br", "saipos.com", "sigmenu.com", "viaverdeshopping.com.br",
    "traveleto.com", "wa.me", "whatsapp.com",
    "facebook.com", "instagram.com", "twitter.com", "x.com", "linkedin.com", "youtube.com", "tiktok.com", "blog.naver.com",
    "wikipedia.org", "wikidata.org", "wikimedia.org", ".gov.br",
    ".phones", ".png", ".jpg", ".jpeg", ".gif", ".webp", ".svg", ".bmp", ".avif",
)
BAD_PATH_PARTS = ("/image/", "/images/", "/media/pictures/", "/showuserreviews-")
IMAGE_ENDS = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".bmp", ".ico", ".avif")

# Page suffixes that hold no text to read.
SKIPPED_PAGE_ENDS = (
    ".jpg", ".jpeg", ".png", ".gif", ".svg", ".ico", ".webp", ".css", ".js", ".woff", ".woff2", ".ttf", ".eot", ".mp3", ".mp4", ".avi",
    ".mov", ".wmv", ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".tar", ".gz", ".rar", ".7z", ".exe", ".dmg", ".apk",
)

# What a URL scores for each word that it contains.
URL_WEIGHTS = {
    "contact": 100, "support": 95, "help": 90, "customer": 85, "about": 80, "team": 78, "leadership": 76, "management": 74, "director": 72,
    "board": 70, "privacy": 68, "legal": 66, "imprint": 64, "career": 62, "job": 60, "press": 58, "media": 56, "terms": 54, "policy": 52, ".pdf": 50,
}

# Signs of another country in a candidate.
FOREIGN_TLDS = (".hk", ".com.hk", ".in", ".my", ".cn", ".sg")
FOREIGN_PHONES = ("+852", "+91", "+86", "+60", "+63", "+254")
FOREIGN_URL_PARTS = ("hong-kong", "hongkong", "/locations/cn/", "/hk/", ".hk/")

# Legal forms; a person's name does not hold one.
CORPORATE_SUFFIX = (
    r"(?i)(?<![\p{L}\p{N}_])(?:aps|a/s|i/s|k/s|p/s|ivs|amba|fmba|smba|gmbh|ag|ohg|kg|ug|e\.?v\.?|ltd\.?|llc|inc\.?|plc|lp|llp|ab|hb|kb"
    r"|sa|sl|sas|sarl|bv|nv|oy|as|sp\.?\s*z\.?\s*o\.?\s*o\.?)(?![\p{L}\p{N}_])"
)
UK_SUFFIXES = ("limited", "ltd", "plc", "llp", "lp", "uk")

# Labels that stand before a representative's name, and labels that end one.
REPRESENTATIVE_LABELS = ("代表取締役", "代表社員", "代表理事", "代表者", "社長", "院長", "理事長", "代表")
REPRESENTATIVE_BLOCKERS = ("会社名", "商号", "所在地", "住所", "電話", "tel", "fax", "設立", "創業", "資本金", "事業内容", "従業員", "営業時間", "定休日", "アクセス", "お問い合わせ")
REPRESENTATIVE_NON_NAMES = ("あいさつ", "挨拶", "ごあいさつ", "ご挨拶", "メッセージ", "プロフィール", "会社概要", "概要", "一覧")

# Legal forms removed from names before they are compared.
NAME_FORMS = (
    "주식회사", "(주)", "㈜", "(유)", "유한회사", "株式会社", "有限会社", "合同会社", "合資会社", "合名会社", "一般社団法人", "一般財団法人",
    "特定非営利活動法人", "npo法人", "co.", "co,", "co ", "inc.", "inc,", "inc ", "corp.", "corp ", "ltd.", "ltd ",
)

# What a contact's title scores, by family; titles that are left out.
LEADER_TITLES = (("chief executive officer|ceo", 300), ("managing director", 260), ("president", 240), ("chairman", 230), ("founder", 220), ("owner", 210), ("partner", 200), ("director", 150), ("head", 120))
FINANCE_TITLES = (("cfo|chief financial officer", 260), ("finance director", 240), ("head of finance", 220), ("finance manager", 200), ("controller", 180), ("vp finance|vice president finance", 170))
ACCOUNTING_TITLES = (("chief accountant", 250), ("accounting manager", 230), ("head of accounting", 220), ("accountant", 180), ("accounts manager", 170), ("finance and accounts", 170))
BLOCKED_TITLES = ("assistant to", "assistance", "coordinator", "chief of staff", "office of the ceo", "executive office", "ceo office", "chief executive officer office", "chief executive officer['’]?s office", "executive assistant.*ceo")

# Titles taken out of a representative before records are merged, in this order.
MERGE_TITLES = ("代表取締役社長", "代表執行役社長", "代表執行取締役", "代表取締役", "取締役代表執行役社長", "代表理事", "理事長", "社長", "ceo", "coo", "cfo")

# What surrounds a person's name, and what is none.
PERSON_PREFIX = r"(?i)^(?:contact(?:\s+name|\s+person)?|representative|rep|name|mr|mrs|ms|dr|eng|er|sheikh|shaikh|sir)\.?\s*[:：-]?\s*"
PERSON_ROLES = "ceo|coo|cfo|cto|owner|founder|managing director|area manager|sales manager|general manager|manager|director|partner"
PERSON_INLINE_ROLES = "executive director|managing director|general manager|deputy manager|manager|director|chairman|chief executive officer|chief executive|ceo|founder|owner|partner|supervisor"
PERSON_COMPANY_HINTS = (
    "llc", "l.l.c", "ltd", "fze", "fzco", "fzc", "company", "trading", "services", "service", "industries", "industrial", "technology", "tech",
    "group", "est", "branch", "bank", "clinic", "hospital", "restaurant", "hotel", "construction", "contracting", "properties", "real estate",
    "development", "solutions", "international", "middle east", "auditors", "auditing", "dmcc",
)
PERSON_NON_NAMES = ("space", "team", "staff", "admin", "office", "support", "sales", "marketing", "info", "contact", "publicidade", "dubai", "uae", "pk")
PERSON_EMPTY = ("", "-", "n/a", "na", "none", "null", "unknown")
ENTITY_HINTS = ("limited", "ltd", "plc", "llp", "lp", "uk", "company", "corporate", "secretaries", "nominees", "services", "holdings", "group", "partners")
COMPANY_HINTS = ("ltda", "s.a", "s/a", "eireli", "comercio", "industria", "servicos", "empresa", "transportes", "construtora")
