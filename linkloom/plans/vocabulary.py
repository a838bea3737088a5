"""The words, hosts and patterns that results depend on. The rule tables among them are defaults of parameters of the functions that use them."""

# kind: (label, timeless)
KINDS = {"news": ("News", False), "tool": ("Tool", True), "read": ("Read", True), "quote": ("Quote", True), "til": ("TIL", True), "awe": ("Curiosity", True)}

# topic patterns over lower-cased text: (pattern, slug, label, facet)
TOPICS = [
    (r"\b(ai|a\.i|llm|llms|gpt|chatgpt|openai|anthropic|claude|gemini|deepseek|grok|mistral|llama|neural|machine learning|\bml\b|prompt|prompts|diffusion|transformer|\brag\b|inference|fine[- ]?tun|agentic|agent|agents|models?)\b", "ai", "AI/ML", "topic"),
    (r"\bopen[- ]?source\b", "opensource", "Open source", "source"),
    (r"\b(css|html|\bdom\b|frontend|front[- ]end|webgpu|wasm|\bpwa\b|service worker|web ?assembly|browser|webrtc|websocket)\b", "web", "Web platform", "topic"),
    (r"\b(javascript|\bjs\b|node|nodejs|npm|pnpm|react|vue|svelte|typescript|\bts\b|deno|\bbun\b|eslint|vite|webpack)\b", "javascript", "JavaScript", "topic"),
    (r"\b(cli|devtool|dev tools|linter|\blint\b|debugger|debug|terminal|docker|kubernetes|\bk8s\b|ci/cd)\b", "devtools", "Dev tools", "topic"),
    (r"\b(database|databases|\bsql\b|postgres|mysql|mongo|mongodb|redis|\bindex\b|indexes|query)\b", "data", "Databases", "topic"),
    (r"\b(career|jobs?|hiring|hire|interview|resume|salary|workplace|productivity|craft)\b", "career", "Career & craft", "topic"),
    (r"\b(security|vulnerabilit|\bcve\b|exploit|encryption|privacy|password|\bauth\b)\b", "security", "Security", "topic"),
    (r"\blangchain|llm[- ]?ops|vector (db|database)|embeddings?\b", "llm-ops", "LLM tooling", "topic"),
]
SOURCE_TAGS = {"wikipedia": "Wikipedia", "video": "Video", "discord": "Discord"}

# first path segments of the code host that are no owners
RESERVED = (
    "apps", "sponsors", "marketplace", "settings", "about", "features", "topics", "collections", "notifications", "orgs", "users", "login", "join", "pricing", "site", "security", "explore", "trending",
    "new", "organizations", "dashboard", "stars", "issues", "pulls", "codespaces", "readme", "search",
)
FURNITURE_HOST = r"^(cdn\.discordapp\.com|media\.discordapp\.net|discord\.(com|gg)|discordapp\.com|tenor\.com|media\.tenor\.com|giphy\.com|media\d*\.giphy\.com|images-ext-\d+\.discordapp\.net)$"
JOB_HOST = (
    r"(^|\.)(boards\.greenhouse\.io|greenhouse\.io|jobs\.lever\.co|lever\.co|jobs\.ashbyhq\.com|ashbyhq\.com|apply\.workable\.com|workable\.com|smartrecruiters\.com|recruitee\.com|breezy\.hr"
    r"|[\w-]+\.myworkdayjobs\.com|wellfound\.com|angel\.co|[\w-]+\.hire\.trakstar\.com|rubyonremote\.com|aijobs\.app|web3\.career|ats\.rippling\.com|jobs\.apple\.com|flipkartcareers\.com"
    r"|naukri\.com|hirist\.com|instahyre\.com|cutshort\.io)$"
)
JOB_PATH = r"^/(careers?|jobs)(/|$)"
JUNK_PARAMETER = r"^(utm_[a-z_]+|ref|ref_src|ref_url|referrer|source|src|fbclid|gclid|mc_cid|mc_eid|igshid|si|feature|spm|_hsenc|_hsmi|hss_channel|at_medium|at_campaign|sk|share)$"
READ_HOST = (
    r"(^|\.)(medium\.com|substack\.com|dev\.to|hashnode\.(dev|com)|blog\.[\w.-]+|[\w-]+\.blog|nytimes\.com|theverge\.com|wired\.com|arstechnica\.com|theatlantic\.com|newyorker\.com|economist\.com"
    r"|ft\.com|bloomberg\.com|quantamagazine\.org|aeon\.co|arxiv\.org)$"
)
# channel name patterns, the first that is found decides
CHANNEL_KINDS = [("read|article|blog|longform|paper", "read"), ("til|learn|today-i", "til"), ("tool|build|ship|oss|project", "tool")]
HIDDEN_CHANNELS = ("liked-phrases", "memes", "introductions", "job-posts")
OPAQUE_HOST = r"(^|\.)(archive\.(is|ph|today|vn|li)|imdb\.com)$"
BOILERPLATE = r"log ?in or sign ?up|sign in to |create an account|enable javascript|subscribe to (continue|read)|we use cookies|are you a robot|access denied|just a moment|checking your browser|please verify"

# newsletter sections by normalised heading
SECTIONS = {
    "news": ["whats happening", "news", "catch up", "catch up with the tech", "catching up", "0x digest", "agi digest", "ai digest", "dev design digest", "dev digest", "code editor updates", "new model drops", "new model and data drops"],
    "awe": ["wild world web", "what brings us to awe", "what brings us two awe", "cool stuff", "something to think about"],
    "til": ["tils", "today i we learnt", "today iwe learnt", "today i learned moments"],
    "read": ["off topic reads watches", "off topic reads listens", "some off topic reads watches", "recommendations", "gadget reccos", "what we have been consuming"],
    "tool": ["builders nest", "cool oss projects", "new tools in town", "new in town", "what we have been trying", "what we have been trying reading", "tools recommendations", "useful links", "playgrounds"],
    "quote": ["wisdom bits", "ponder worthy words", "quote of the week", "a quote that got me thinking"],
}
EXCLUDED_SECTIONS = [
    "meme of the week", "weekly standup", "wallpaper of the week", "from the authors laptop", "note", "where do we stand in the year",
    "where do we stand in the year powered by year progress bot", "what are we up to", "what weve been up to", "things i have been up to", "shoutout", "job posts", "fin bits", "watching",
]


def excluded_sections(newsletter: str) -> list[str]:
    """The excluded headings, with the one that names the newsletter (in the form that headings are looked up by)."""
    return [*EXCLUDED_SECTIONS, f"friends of {newsletter}"]


# titles, descriptions and links in a page's head, and the markup of editions
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
META_FIRST, META_LAST = "(?is)<meta[^>]+(?:property|name)=[\"']{name}[\"'][^>]*?content=[\"']([^\"']*)[\"']", "(?is)<meta[^>]+content=[\"']([^\"']*)[\"'][^>]*?(?:property|name)=[\"']{name}[\"']"
HEADING = r"(?s)<h([1-6])[^>]*>(.*?)</h\1>"
UNIT = r"(?s)<li[^>]*>.*?</li>|<blockquote[^>]*>.*?</blockquote>"
STRONG_LINK = r"(?s)^(.*?)<strong>\s*<a\b[^>]*href=\"([^\"]+)\"[^>]*>(.*?)</a>(.*)$"
PLAIN_LINK = r"(?s)^(.*?)<a\b[^>]*href=\"([^\"]+)\"[^>]*>(.*?)</a>(.*)$"
QUOTE_DASH = "—–―~‒-"
QUOTE_CUT = r"\s+[~–—―‒]\s+|\s+--\s+"
MARKER = r"^\s*([\x{1F000}-\x{1FAFF}\x{2190}-\x{2BFF}\x{2600}-\x{27BF}\x{FE0F}\x{200D}]+)"
VIDEO_HOST, VIDEO_WORD = r"(youtube\.com|youtu\.be|vimeo\.com)$", r"\b(video|watch|podcast|youtube)\b"
# text around links
LEAD = r"^[\s.,;:!?)\]…–—-]+"
CONNECTIVE = r"(?i)^(and|but|so|also|plus|yet)\b[\s,]*"
STOPS = [".", "!", "?", ")", "”", '"']
BARE_URL = r"(?i)https?://[^\s<>()\[\]\"'`]+[^\s<>()\[\]\"'`.,;:!?]"
MARKED_LINK = r"\[[^\]]{1,200}\]\(https?://[^\s)]+\)"


def newsletter_furniture(site: str) -> str:
    """Pattern of links that only serve the newsletter at site (a pattern too)."""
    return rf"(^|\.)(wow|a|p|latest|why|files)\.{site}$|{site}/(subscribe|survey)|notebooklm\.google\.com|/subscribe|/survey"


def newsletter_link(site: str) -> str:
    """Pattern of links to editions of the newsletter at site."""
    return rf"{site}/(?:p/)?(\d+)"
