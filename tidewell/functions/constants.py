"""Fixed values of the offer domain: names, tables, word lists and patterns that results depend on."""

BANK_ALIASES = {
    "emirates nbd": "Emirates NBD",
    "enbd": "Emirates NBD",
    "first abu dhabi bank": "First Abu Dhabi Bank",
    "fab": "First Abu Dhabi Bank",
    "abu dhabi commercial bank": "ADCB",
    "adcb": "ADCB",
}
CARD_ALIASES = {"visa infinite": "Visa Infinite", "visa signature": "Visa Signature", "visa platinum": "Visa Platinum", "mastercard": "Mastercard"}
CATEGORY_CODES = {
    "grocery": ["5411"],
    "dining": ["5812", "5814"],
    "travel": ["3000", "4511", "7011", "4722"],
    "fuel": ["5541", "5542"],
    "shopping": ["5311", "5331", "5399"],
    "fashion": ["5651", "5691", "5699"],
    "electronics": ["5732", "5734"],
    "entertainment": ["7832", "7922", "7996"],
    "jewelry": ["5944"],
}
CATEGORY_WORDS = {
    "dining": "dining|restaurant|food|drink|cafe",
    "travel": "travel|hotel|flight|airline|airport",
    "shopping": "shopping|retail|mall|hypermarket",
    "entertainment": "entertainment|theme park|cinema|theatre|theater",
    "fashion": "fashion|apparel|clothing",
    "fuel": "fuel|petrol|gas station",
}
PAGE_CATEGORY_WORDS = {
    "grocery": r"grocery|supermarket|carrefour|lulu|spinneys",
    "dining": r"dining|restaurant|food|talabat|zomato|deliveroo",
    "travel": r"travel|flight|hotel|booking\.com|agoda|airline",
    "fuel": r"fuel|petrol|enoc|adnoc",
    "shopping": r"shopping|retail|mall",
    "fashion": r"fashion|clothing|apparel|namshi|noon",
    "electronics": r"electronics|gadget|sharaf\s*dg|amazon",
    "entertainment": r"entertainment|cinema|movie|vox|ticket",
    "jewelry": r"jewelry|jewellery|gold|diamond",
}
DISCOUNT_TYPES = ["percent", "fixed", "cashback", "coupon", "points", "emi", "installment", "complimentary", "other"]
NOT_MERCHANTS = r"^(?:cards?\s*&\s*rewards?|seasonal offers?|online offers?)$"
TRACKING_PARAMS = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "mc_cid", "mc_eid", "ref", "source", "campaign"]
NOT_COUPONS = ["HTTP", "HTTPS", "HTML", "TRUE", "FALSE", "NULL", "CODE", "PROMO", "CLICK", "HERE", "MORE", "SHOW", "VIEW", "SHOP", "DEAL", "DEALS", "SAVE", "OFF", "UAE", "AED", "USD", "THE", "AND", "FOR", "WITH"]
GARBAGE_TITLES = [r"^oops!?$", r"^404\b", r"^page not found", r"^error\b", r"^not found$", r"^access denied", r"^login\b", r"^sign in$"]
CATEGORY_TITLES = [
    r"^cards?\s*&\s*rewards?$",
    r"^seasonal offers?$",
    r"^travel\s*&?\s*hotel offers?$",
    r"^food\s*&?\s*drink offers?$",
    r"^fashion\s*&?\s*retail offers?$",
    r"^online offers?$",
    r"^entertainment offers?$",
    r"^wellness offers?$",
    r"^0%\s*epp offers?$",
    "^العربية",
]
NETWORK_DETAIL_TITLE = r"^cards?\s*&\s*rewards?$"
STRICT_SOURCES = ["emiratesNbd", "adcb", "mashreq", "fab", "dib", "adib", "rakBank", "hsbc", "cbd", "visaUAE"]
BANK_BY_SOURCE = {
    "emiratesNbd": "Emirates NBD",
    "adcb": "ADCB",
    "mashreq": "Mashreq",
    "fab": "First Abu Dhabi Bank",
    "dib": "Dubai Islamic Bank",
    "adib": "ADIB",
    "rakBank": "RAK Bank",
    "hsbc": "HSBC",
    "cbd": "CBD",
    "citibank": "Citibank",
    "scb": "Standard Chartered",
}
RELIABILITY = {
    "emiratesNbd": 0.90, "visaUAE": 0.85, "fab": 0.80, "adcb": 0.82, "mashreq": 0.80, "rakBank": 0.78, "dib": 0.76, "hsbc": 0.80,
    "citibank": 0.78, "cbd": 0.75, "adib": 0.82, "scb": 0.70, "groupon": 0.70, "cuponation": 0.68, "picodi": 0.65, "couponsAe": 0.65,
    "wethrift": 0.62, "smiles": 0.72, "noon": 0.68, "couponFeed": 0.65, "merchant": 0.70, "discovery": 0.20, "generic": 0.50,
}
DEFAULT_RELIABILITY = 0.5
SOURCE_CATEGORY = {
    "emiratesNbd": "bank", "fab": "bank", "adcb": "bank", "mashreq": "bank", "rakBank": "bank", "dib": "bank", "hsbc": "bank", "citibank": "bank",
    "cbd": "bank", "visaUAE": "network", "adib": "bank", "scb": "bank", "mastercard": "network", "groupon": "coupon", "cuponation": "coupon",
    "picodi": "coupon", "couponsAe": "coupon", "wethrift": "coupon", "couponFeed": "coupon", "smiles": "coupon", "noon": "merchant",
    "merchant": "merchant", "discovery": "discovery",
}
#: (pattern on the lower-case URL, source type), first match wins
SOURCE_BY_URL = [
    (r"emiratesnbd\.com", "emiratesNbd"),
    (r"bankfab\.com", "fab"),
    (r"adcb\.com", "adcb"),
    (r"mashreq\.com", "mashreq"),
    (r"rakbank\.ae", "rakBank"),
    (r"\bdib\.ae\b", "dib"),
    (r"hsbc\.ae", "hsbc"),
    (r"citibank\.ae", "citibank"),
    (r"\bcbd\.ae\b", "cbd"),
    (r"visamiddleeast\.com|visa\.co\.ae", "visaUAE"),
    (r"mastercard\.(?:ae|com)", "mastercard"),
    (r"groupon\.ae", "groupon"),
    (r"cuponation\.ae", "cuponation"),
    (r"picodi\.com/ae", "picodi"),
    (r"coupons\.ae", "couponsAe"),
    (r"wethrift\.com", "wethrift"),
    (r"smiles\.ae", "smiles"),
    (r"noon\.com.*(?:offer|deal|coupon)|(?:offer|deal|coupon).*noon\.com", "noon"),
    (r"coupon|promo-code|voucher", "couponFeed"),
    (r"google\.com.*/search|/search.*google\.com", "discovery"),
]
CURRENCIES = "(?:AED|Dhs|EUR|USD|AUD|SGD|GBP|FJD)"
ZERO_RATE = r"0%\s*(?:interest|epp|easy\s+payment|installment|instalment)"
PATTERNS = {
    "cashback": r"(?:up\s+to\s+)?(\d{1,2}(?:\.\d{1,2})?)\s*%\s*(?:cash\s*back|cashback)",
    "cashback_any": r"cash[\s-]*back",
    "percent": r"(?:up\s+to\s+)?(\d{1,2}(?:\.\d{1,2})?)\s*%\s*(?:off|discount|save|cashback)?",
    "percent_off": r"(\d{1,2}(?:\.\d{1,2})?)\s*%\s*off",
    "fixed": "(?:AED|Dhs|د\\.?إ)\\s*(\\d{1,3}(?:,\\d{3})*(?:\\.\\d{1,2})?|\\d+(?:\\.\\d{1,2})?)\\s*(?:off|discount|save|cashback)?",
    "fixed_off": r"(?:save|get)\s+(?:AED|Dhs)\s*(\d{1,3}(?:,\d{3})*(?:\.\d{1,2})?|\d+(?:\.\d{1,2})?)",
    "coupon": r"(?:coupon|promo(?:tion)?\s*code|voucher\s*code|use\s+code|code)[\s:]+([A-Z][A-Z0-9_-]{2,19})",
    "min_spend": r"(?:min(?:imum)?\s*(?:spend|purchase|order|cart(?:\s*value)?|monthly\s*spend)|spend\s*(?:of|at\s*least))\s*(?:AED|Dhs)?\s*(\d+(?:[.,]\d{1,2})?)",
    "cap": r"(?:capped?\s+at|max(?:imum)?|up\s+to)\s*(?:AED|Dhs)?\s*(\d+(?:[.,]\d{1,2})?)\s*(?:per\s+month|monthly|cashback|discount)?",
    "starting": r"starting\s+from\s+(?:AED|Dhs)\s*(\d[\d,]*)",
    "foreign_cashback": r"(?:EUR|USD|AUD|SGD|GBP|FJD)\s*(\d+(?:[.,]\d+)?)\s*cashback",
    "complimentary": r"complimentary|free\s+(?:flight|lounge|access|valet)",
    "emi": r"(?:\d+)\s*(?:months?|EMI)\s*(?:installment|instalment|plan)?",
    "points": r"(\d+(?:,\d{3})*)\s*(?:bonus\s+)?(?:points|miles|rewards?)",
    "instalment": r"(?:starting\s+at|from|minimum\s+transaction|easy\s+payment\s+plan|0%\s*(?:epp|installment|instalment)|flexi\s+instalment)",
    "signal": r"(?:cashback|%\s*off|AED\s*\d|valid until|minimum spend|cardholder)",
    "error_page": r"can't seem to find the page|page you're looking for|404 not found|oops!",
    "network_shell": r"try one of these popular visa pages instead",
    "help_title": r"help (?:centre|center)|customer support|privacy policy",
    "login_text": r"log in or register",
}
STALE_DAYS = {"couponFeed": 7, "merchant": 10}
DEFAULT_STALE_DAYS = 14
CONFIDENCE_FLOOR = 0.4
