"""Word lists, patterns and dimension tables that decide results.  Patterns ignore case."""

# --- text -------------------------------------------------------------------------------------

STOPWORDS = ("and", "the", "of", "a", "an", "&", "to", "in", "for")

KEYWORDS = (
    "revenue", "revenues", "net sales", "net sale", "sales", "segment", "segments", "disaggregated", "by product", "by type", "by geography",
    "cloud", "advertising", "subscription", "subscriptions", "services", "total", "year ended", "in millions", "in billions", "in thousands",
)

ACCOUNTING_DENY = (
    r"\bperformance obligation\b", r"\bstand-alone selling price\b", r"\bssp\b", r"\ballocated\b", r"\brecognized\b", r"\bdeferred\b", r"\bamortization\b", r"\bcontract liabilit",
    r"\bunearned\b", r"\bASC\s+\d", r"\bGAAP\b", r"\brevenue recognition\b", r"\brecord revenue\b", r"\bgross\b.*\bnet of\b", r"\bconsolidated\b", r"\breclassification\b",
    r"\bsee note\b", r"\brefer to\b", r"\bin the table\b", r"\bas shown\b", r"\bincreased due to\b", r"\bdecreased due to\b", r"\bprimarily due to\b", r"\bhigher sales of\b",
    r"\blower sales of\b", r"\bdriven by\b", r"\bprimarily driven\b", r"\bcompared to\b.*\bprior\b", r"\byear over year\b", r"\bfrom a year ago\b", r"\bgrowth depends\b", r"\bwe expect\b",
    r"\bwe anticipate\b", r"\bwe believe\b", r"\bwe continue\b", r"\bfiscal\s+\d{4}\b", r"\bfor the year\b", r"\bduring the year\b", r"\bquarter\b",
)

PAGE_NOISE = (r"Table\s+of\s+Contents", r"^\d+\s*$", r"Page\s+\d+", r"F-\d+", r"Item\s+\d+[A-Z]?\.", r"PART\s+[IVX]+", r"^[\d\s]+Table of Contents")

HEADER_MARKERS = ("year ended", "december 31", "june 30", "september 30", "(in millions)", "(in thousands)", "% change", "% Change", "total revenue", "total net sales", "year-over-year", "fiscal year")

LABEL_EXPANSIONS = {
    "advertising": ("advertising", "ad revenue", "ads", "advertising services"),
    "subscription": ("subscription", "subscriptions", "subscriber"),
    "services": ("services", "service revenue", "service offerings"),
    "cloud": ("cloud", "cloud services", "cloud computing"),
    "gaming": ("gaming", "game", "games"),
    "compute": ("compute", "data center", "computing"),
    "networking": ("networking", "network"),
    "professional visualization": ("professional visualization", "visualization", "professional"),
    "automotive": ("automotive", "auto", "vehicle"),
    "online stores": ("online stores", "online store", "e-commerce"),
    "physical stores": ("physical stores", "physical store", "retail stores"),
    "third-party seller": ("third-party seller", "third party seller", "marketplace", "3p seller"),
    "aws": ("aws", "amazon web services", "cloud services"),
}

# --- the table gate ---------------------------------------------------------------------------

GATE_STRICT = (
    r"\bunearned\s+revenue\b", r"\bdeferred\s+revenue\b(?!\s+recognition)", r"\bcontract\s+liabilities?\b", r"\bremaining\s+performance\s+obligation", r"\bderivative\s+instruments?\b", r"\bhedging\s+instruments?\b",
    r"\blease\s+(assets?|liabilities?|obligations?)\b", r"\boperating\s+lease\s+(cost|liability|asset)\b", r"\bfinance\s+lease\s+(cost|liability|asset)\b", r"\bdeferred\s+tax\b", r"\bunrecognized\s+tax\b",
)
GATE_POSITIVE = (
    r"\bdisaggregation\s+of\s+revenue\b", r"\brevenue\s+classified\s+by\b", r"\bnet\s+sales\s+by\s+(product|category|segment)\b", r"\brevenue\s+by\s+(product|service|segment)\b",
    r"\bsignificant\s+product\s+and\s+service\s+offerings\b", r"\btotal\s+net\s+sales\b", r"\btotal\s+revenues?\b", r"\bsegment\s+results\b", r"\bresults\s+of\s+operations\s+by\s+segment\b",
    r"\biphone\b.*\bmac\b", r"\bintelligent\s+cloud\b", r"\bgoogle\s+services\b", r"\bgoogle\s+cloud\b",
)
GATE_CONTEXT = (
    r"\brevenue\s+by\s+geography\b", r"\bgeographic\s+(regions?|areas?)\b", r"\$\s*100\s+invested", r"\bcumulative\s+total\s+return\b", r"\bshareholder\s+return\b", r"\b(stock|share)\s+(price\s+)?performance\b",
    r"\bcomparison\s+of\s+\$?\s*100\b", r"\b(?:s&p|nasdaq|russell|dow)\b", r"\b(philadelphia|p\.?h\.?l\.?x\.?)\s*semiconductor\b", r"\bindex\b.*\b(?:return|performance|value)\b", r"\bnet\s+(income|earnings)\b",
    r"\bearnings?\s+(before|after)\s+(?:income\s+)?tax\b", r"\bincome\s+before\s+(?:income\s+)?tax\b", r"\bconsolidated\s+statements?\s+of\s+(operations|income|earnings)\b", r"\bsegment\s+(operating\s+)?(income|earnings|profit)\b",
    r"\bgross\s+dollar\s+volume\b", r"\bgdv\b", r"\bpayment[s]?\s+volume\b", r"\bprocessed\s+transactions?\b", r"\btotal\s+volume\s+\(\$?b\)", r"\bcards?\s+\([mb]\)",
)
REVENUE_SIGNAL = r"\brevenue\b|\bnet\s+sales\b"

# --- dimensions and rows ----------------------------------------------------------------------

DIM_PRODUCT = (r"groups?\s+of\s+similar\s+products?\s+(and|&)\s+services?", r"disaggregat(ed|ion)\s+(of\s+)?revenue", r"revenue\s+by\s+(product|service|category|type)", r"net\s+sales\s+by\s+(product|category)", r"by\s+(product|service)\s+(line|category|type)")
DIM_END_MARKET = (r"revenue\s+by\s+end\s*[-\s]?market", r"by\s+end\s*[-\s]?market", r"end\s*[-\s]?market\s+revenue")
DIM_GEOGRAPHY = (r"revenue\s+by\s+geograph", r"by\s+geograph", r"geographic\s+(area|region)", r"revenue\s+by\s+region")
DIM_SEGMENT = (r"reportable\s+segment", r"operating\s+segment", r"segment\s+(revenue|result|information)", r"revenue\s+by\s+segment")
ROW_SOURCE = (r"^\s*advertising\s*$", r"^\s*other\s+revenue\s*$", r"^\s*subscription\s*(revenue|services?)?\s*$", r"^\s*licensing\s*(revenue)?\s*$", r"^\s*service\s+fees?\s*$", r"^\s*product\s+sales?\s*$")
ROW_SEGMENT = (r"family\s+of\s+apps", r"reality\s+labs", r"intelligent\s+cloud", r"productivity\s+and\s+business", r"personal\s+computing", r"google\s+(services|cloud)", r"other\s+bets", r"north\s+america", r"international")
ROW_ADJUSTMENT = (r"\bhedging\s+(gains?|losses?)\b", r"^\s*hedging\b", r"\bcorporate\s+(costs?|expenses?|overhead)\b", r"^\s*corporate\s*$", r"\belimination", r"\bintercompany\b", r"\breconcil", r"\bunallocated\b")
ROW_TOTAL = (r"^\s*total\s+net\s+sales\s*$", r"^\s*total\s+revenues?\s*$", r"^\s*total\s*$", r"^\s*consolidated\s+total")
ROW_SKIP = (r"\bdeferred\s+revenue\b", r"\bcontract\s+liabil", r"\bportion\s+of\s+total\b", r"\bincluded\s+in\s+deferred\b", r"\bunearned\b", r"^\s*$")
ADJUSTMENT_PARTS = ("hedging", "hedge", "corporate", "elimination", "reconcil")
TOTAL_PREFIXES = ("total revenue", "total revenues", "total net sales", "total net revenue")
COST_ROW = (
    r"\b(cost\s+of|gross\s+margin|operating\s+(income|expense|loss)|research\s+and\s+development|selling.*general|amortization|restructuring|gross\s+profit|total\s+cost|percent\s+increase|"
    r"total\s+operating\s+expenses?|total\s+expenses?|income\s+from\s+operations|net\s+income|depreciation)\b"
)
TOTAL_ROW = r"^(total\s+)?(net\s+)?(revenue|sales)s?$|^net\s+revenue$"
CHANGE_COLUMN = r"\b(%|percent|change|variance|increase|decrease)\b"
DATE_LABEL = r"\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d|^\d{1,2}/\d{1,2}/\d{2,4}$"
STAFF_LABEL = r"\b(?:employees?|fte|headcount|full[- ]time)\b"
NON_REVENUE = (
    r"(members?|cardholders?|households?|employees?|stores?(?!\s+ancillary)|square\s+feet|locations?|countries?|markets?|percentage|margin\s+percentage|total\s+paid|gold\s+star|business.*affiliates|"
    r"merchandise\s+costs?|less\s+merchandise|cost\s+of\s+sales|income\s+from\s+operations|operating\s+income|net\s+income|total\s+income\s+from|income\s+\(loss\)|"
    r"personnel|salaries|wages|compensation|network\s+and\s+processing|data\s+center|infrastructure|professional\s+fees|legal\s+fees|consulting|general\s+and\s+administrative|g\s*&\s*a|administrative|"
    r"litigation\s+provision|legal\s+provision|settlement|investment\s+(income|expense)|interest\s+(income|expense)|income\s+tax\s+provision|tax\s+expense|provision\s+for\s+tax|"
    r"stock|common\s+stock|preferred\s+stock|treasury|depreciation|amortization|impairment|earnings?\s+per\s+share|diluted\s+earnings|basic\s+earnings|non.?gaap|adjusted|total\s+operating\s+expenses?|operating\s+expenses?)"
)
BREAKDOWN_POSITIVE = ("revenue by", "net sales by", "revenue from", "disaggregation of revenue", "total revenue", "total net sales")
BREAKDOWN_NEGATIVE = ("net income", "operating expense", "gross margin", "gross profit", "operating income", "cost of revenue", "research and development", "deferred revenue", "liability", "payable", "accrued")
BREAKDOWN_GEOGRAPHY = ("geographic", "geography", "united states", "singapore", "taiwan", "china", "europe")

# --- scouting and the anchor ------------------------------------------------------------------

SECTIONS = {
    "has_item1_business": (r"\bitem\s*1[.\s]+business\b", r"\bitem\s*1\b(?![\dA])"),
    "has_item7_mda": (r"\bitem\s*7[.\s]+management", r"\bmanagement['’]?s?\s+discussion\s+and\s+analysis\b", r"\bmd&a\b"),
    "has_item8_notes": (r"\bitem\s*8[.\s]+financial\s+statements\b", r"\bnotes\s+to\s+(?:the\s+)?(?:consolidated\s+)?financial\s+statements\b"),
    "has_note2_revenue": (r"\bnote\s*2[.\s:—–-]+\s*revenue\b", r"\b(?:note|notes)\s+\d+[.\s:—–-]+\s*revenue\s+(?:recognition|from\s+contracts)\b", r"\brevenue\s+recognition\b", r"\bcontracts?\s+with\s+customers?\b"),
    "has_segment_note": (r"\bnote\s*\d+[.\s:—–-]+\s*segment\b", r"\bsegment\s+(?:information|reporting|results)\b", r"\breportable\s+segments?\b"),
}
SCOUT_A = (
    r"disaggregat(?:ed|ion)\s+(?:of\s+)?revenue", r"revenue\s+(?:from\s+external\s+customers\s+)?by\s+(?:major\s+)?(?:products?\s+(?:and|&)\s+services?|category)", r"groups?\s+of\s+similar\s+products?\s+(?:and|&)\s+services?",
    r"net\s+sales\s+by\s+(?:category|product|reportable\s+segment)", r"revenue\s+by\s+source", r"sources?\s+of\s+revenue", r"family\s+of\s+apps.*reality\s+labs", r"revenue\s+by\s+user\s+geography",
)
SCOUT_B = (r"revenue\s+by\s+(?:reportable\s+)?segment", r"segment\s+revenue", r"operating\s+segment", r"segment\s+information", r"reportable\s+segment")
SCOUT_C = (r"results\s+of\s+operations", r"revenue\s+(?:analysis|summary|breakdown)", r"net\s+sales\s+(?:and|by)")
SCOUT_GEOGRAPHY = (r"revenue\s+by\s+geograph", r"geographic\s+(?:area|region|breakdown)", r"by\s+(?:country|region)")
SCOUT_REJECT = (r"consolidated\s+statements?\s+of\s+(operations|income|earnings)", r"statements?\s+of\s+consolidated\s+(operations|income)", r"\bnet\s+income\b.*\bearnings\s+per\s+share\b")
PL_MARKERS = ("cost of revenue", "gross profit", "operating income", "net income", "earnings per share", "provision for income tax", "costs and expenses", "income from operations", "income (loss) from operations", "operating margin", "operating loss")
STATEMENT_CAPTION = (r"consolidated\s+statements?\s+of\s+(operations|income|earnings)", r"statements?\s+of\s+consolidated\s+(operations|income|earnings)", r"consolidated\s+(income|operations)\s+statements?")
STATEMENT_MARKERS = (r"cost\s+of\s+(revenue|sales|goods)", r"gross\s+(profit|margin)", r"operating\s+(income|expenses?)", r"net\s+income", r"income\s+before\s+(income\s+)?tax", r"earnings?\s+per\s+share")
ANCHOR_ROW = (r"^\s*total\s+net\s+(revenue|sales)\s*$", r"^\s*net\s+(revenue|sales)\s*$", r"^\s*total\s+(revenue|revenues|net\s+sales)\s*$", r"^\s*(revenue|revenues)\s*$", r"^\s*sales\s+and\s+other\s+operating\s+revenue", r"^\s*net\s+sales\s+and\s+operating\s+revenues?")
ESTIMATE_ROW = (r"^\s*total\s+(net\s+)?(revenue|sales)", r"^\s*total\s*$")

# --- validation and reconciliation ------------------------------------------------------------

STATEMENT_NAMES = (
    "net income", "gross margin", "operating expense", "operating income", "income from operation", "earnings per share", "diluted share", "basic share", "cost of revenue", "cost of sales", "gross profit", "interest expense",
    "interest income", "tax expense", "income tax", "depreciation", "amortization", "ebitda", "net profit", "net loss", "net revenue", "research and development", "r&d expense", "administrative expense", "selling expense",
    "marketing expense", "total expense", "% of", "eps", "per share",
)
CONTRA_REVENUE = (r"\bclient\s+incentive", r"\bcustomer\s+incentive", r"\brebate", r"\bdiscount", r"\ballowance", r"\bpromotion", r"\bcoupon")
EXPECTED_SEGMENTS = {"META": (r"\bfamily\s+of\s+apps\b", r"\breality\s+labs\b"), "COST": (r"\bmembership\s+fee", r"\bmerchandise\s+sales"), "XOM": (r"\bupstream\b", r"\bdownstream\b", r"\bchemical\b")}
GRANULAR_WORDS = ("advertising", "subscription", "other revenue", "cloud", "aws")
SUBTOTAL_WORDS = ("family of apps", "foa", "total family of apps")
VIEW_DATE = r"^(december|january|february|march|april|may|june|july|august|september|october|november)\s+\d|^\d{4}$|^(fiscal|fy|year)\s*(20)?\d{2}"
VIEW_GEOGRAPHY = (
    r"^(united\s+states(\s+and\s+canada)?|u\.s\.\s*|americas?\s*|europe\s*|asia\s*|apac\s*|asia.?pacific\s*|emea\s*|latam\s*|rest\s+of\s+(the\s+)?world|international\s*|north\s+america\s*|"
    r"canada\s*|united\s+kingdom\s*|china\s*|japan\s*|germany\s*|france\s*)$"
)

# --- chunks, retrieval, descriptions ----------------------------------------------------------

CHUNK_SECTIONS = {
    "item1": r"ITEM\s*1[^0-9A-Z].*?BUSINESS",
    "item1a": r"ITEM\s*1A.*?RISK\s+FACTORS",
    "item7": r"ITEM\s*7[^A-Z].*?MANAGEMENT.{0,30}DISCUSSION",
    "item8": r"ITEM\s*8[^A-Z].*?FINANCIAL\s+STATEMENTS",
    "note_segment": r"NOTE\s*\d+\s*[-–—]?\s*(SEGMENT|OPERATING\s+SEGMENT)",
    "note_revenue": r"NOTE\s*\d+\s*[-–—]?\s*REVENUE",
}
NOTE_DEFINITION = (
    r"\bconsists?\s+of\b", r"\bincludes?\b.*\b(?:products?|services?|offerings?)\b", r"\bgenerat(?:es?|ed)\s+(?:from|by)\b", r"\bcomprises?\b", r"\bprovides?\s+(?:products?|services?)\b",
    r"\bofferings?\s+(?:include|such as)\b", r"\bsales?\s+of\b", r"\bdelivery\s+of\b", r"\bsuch\s+as\b.*\b(?:products?|services?)\b",
)
NOTE_ACCOUNTING = (
    r"\bperformance\s+obligat", r"\brecogniz(?:es?|ed|ing)\s+(?:revenue|when|upon|at)\b", r"\bprincipal\s+(?:vs\.?|versus)\s+agent\b", r"\bSSP\b|\bstand-alone\s+selling\s+price\b", r"\bASC\s+\d{3}\b",
    r"\bcontract\s+(?:liability|liabilities|asset)\b", r"\ballocation\b", r"\bcontrol\s+transfers?\b", r"\bsatisf(?:ied|action)\b.*\bobligation\b", r"\btransaction\s+price\b", r"\bvariable\s+consideration\b",
    r"\bpoint\s+in\s+time\b", r"\bover\s+time\b.*\brecog", r"\bdeferred\s+revenue\b", r"\bunearned\s+revenue\b", r"\bcontract\s+cost\b",
)
NOTE_STRONG = (r"\bperformance\s+obligat", r"\bSSP\b", r"\bASC\s+606\b", r"\bprincipal\s+(?:vs|versus)\s+agent\b")
DEFINITION_BOOST = (r"\bconsists?\s+of\b", r"\bincludes?\b", r"\bcomprises?\b", r"\bgenerat(?:es?|ed)\s+from\b", r"\bprovides?\s+(?:products?|services?)\b", r"\bsales?\s+of\b")
DEPRIORITIZED = ("item1a", "risk_factors", "liquidity")
BLOCKED = ("note_revenue_recognition",)
PREFERRED = ("note_revenue_sources", "note_revenue", "note_segment", "item1", "table_footnote", "table_before")
PRODUCT_STOPWORDS = (
    "The", "This", "These", "Our", "We", "Company", "Revenue", "Services", "Products", "Business", "Segment", "Total", "United", "States", "North", "America", "International", "Operating", "Income", "Net", "Sales", "Cost", "Gross",
    "Year", "Period", "Quarter", "Annual", "Fiscal", "Item", "Part", "Note", "Table", "Form", "SEC", "Filed", "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
    "AND", "THE", "FOR", "FROM", "WITH", "THAT", "HAVE", "HAS", "WAS", "WERE", "BEEN", "BEING", "WILL", "WOULD", "COULD",
    "SSP", "ASC", "GAAP", "ASU", "IFRS", "US", "USD", "Allocation", "Recognition", "Deferred", "Amortization", "Performance", "Obligation", "Contract", "Liability", "Principal", "Agent", "Transfer", "Control", "Price",
    "Transaction", "Variable", "Consideration", "Timing", "Recognized", "Recognizes", "Accounting", "Policy", "Measurement", "Fair", "Value", "Standard",
)
PEER_HEADINGS = ("iphone", "mac", "ipad", "services", "wearables", "home", "accessories", "wearables, home and accessories", "products", "total net sales", "item 2", "item 3", "business", "properties", "legal proceedings")
CHILD_HEADINGS = ("advertising", "apple care", "applecare", "cloud services", "digital content", "payment services", "other services", "app store", "apple music", "apple tv+", "apple arcade", "apple news+", "apple fitness+", "icloud", "apple card", "apple pay")

# --- dimension tables -------------------------------------------------------------------------

ITEM_SEGMENT = (
    ("MSFT", "Server products and cloud services", "Intelligent Cloud"),
    ("MSFT", "Enterprise and partner services", "Intelligent Cloud"),
    ("MSFT", "Microsoft 365 Commercial products and cloud services", "Productivity and Business Processes"),
    ("MSFT", "LinkedIn", "Productivity and Business Processes"),
    ("MSFT", "Dynamics products and cloud services", "Productivity and Business Processes"),
    ("MSFT", "Microsoft 365 Consumer products and cloud services", "Productivity and Business Processes"),
    ("MSFT", "Gaming", "More Personal Computing"),
    ("MSFT", "Windows and Devices", "More Personal Computing"),
    ("MSFT", "Search and news advertising", "More Personal Computing"),
    ("MSFT", "Other", "Other"),
    ("GOOGL", "Google Search & other", "Google Services"),
    ("GOOGL", "YouTube ads", "Google Services"),
    ("GOOGL", "Google Network", "Google Services"),
    ("GOOGL", "Google subscriptions, platforms, and devices", "Google Services"),
    ("GOOGL", "Google Cloud", "Google Cloud"),
    ("GOOGL", "Other Bets", "Other Bets"),
    ("META", "Advertising", "Family of Apps (FoA)"),
    ("META", "Other revenue", "Family of Apps (FoA)"),
    ("META", "Revenue", "Reality Labs (RL)"),
    ("NVDA", "Compute", "Compute & Networking"),
    ("NVDA", "Networking", "Compute & Networking"),
    ("NVDA", "Automotive", "Compute & Networking"),
    ("NVDA", "Gaming", "Graphics"),
    ("NVDA", "Professional Visualization", "Graphics"),
)
SUBTOTALS = (
    *(("GOOGL", x) for x in ("Google Services", "Google Services total", "Google advertising")),
    *(("AMZN", x) for x in ("Consolidated", "Total", "Total net sales")),
    *(("META", x) for x in ("Family of Apps", "Family of Apps (FoA)", "Total revenue", "Total")),
    *(("NVDA", x) for x in ("Total", "Total revenue", "Data Center", "Compute & Networking", "Graphics", "Revenue", "Operating income", "Operating income (loss)", "Other segment items", "Other segment items (1)")),
)
ADJUSTMENTS = tuple(("GOOGL", x) for x in ("Hedging gains (losses)", "Hedging gains", "Hedging losses"))
XBRL_TAGS = ("Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax", "RevenueFromContractWithCustomerIncludingAssessedTax", "SalesRevenueNet", "SalesRevenueGoodsNet", "SalesRevenueServicesNet", "NetRevenues")
DIMENSION_PRIORITY = ("product_service", "revenue_source", "end_market", "segment")
KEYWORD_HINTS = (
    *(("AAPL", x) for x in ("net sales", "total net sales", "category", "product / service")),
    *(("MSFT", x) for x in ("significant product and service offerings", "server products and cloud services", "microsoft 365", "gaming", "linkedin", "windows and devices", "search and news advertising", "dynamics products and cloud services")),
    *(("GOOGL", x) for x in ("disaggregation of revenue", "google search & other", "youtube ads", "google network", "subscriptions, platforms, and devices", "hedging gains", "total revenues")),
)
