"""Values that decide the results: patterns, word lists, column names.

Every value here is fixed by the job's contract (what counts as a size, which
image paths are shop furniture, how the feed columns are called).  Patterns are
in Java syntax; ``(?iuU)`` makes case folding, ``\\s``, ``\\w`` and ``\\b`` follow
Unicode, which Cyrillic text needs.
"""

# --- fixed values ---------------------------------------------------------

PRICE_PATTERN = r"(?iuU)([0-9]+(?:[\s,.][0-9]{1,2})?)\s*(?:€|&euro;|eur\b)"

SIZE_PATTERN = (
    r"(?iuU)(?<![\w])(?<num>\d+(?:[\.,]\d+)?)\s*"
    r"(?<unit>мл\.?|ml\.?|мил[иі]лит(?:ъра?|ра)?|л\.?|l\.?|лит(?:ър|ра|ри)?|гр\.?|г\.?|g\.?|kg\.?|кг\.?)\b"
)

THUMB_PATTERN = (
    r"-(?:64|100|150|300|320|450|600|768|800)"
    r"x(?:64|100|150|300|320|450|600|768|800)(?=\.)"
)

SENTENCE_SPLIT_PATTERN = r"(?U)(?<=[.!?])\s+|\s*[•\-–]\s+"

SKU_NON_WORD_PATTERN = r"[^0-9A-Za-zА-Яа-я._-]+"

WEBP_CACHE_PATH = "/webp-express/webp-images"

SKIPPED_IMAGE_PARTS = (
    "/logo",
    "logo-",
    "favico",
    "top-seller",
    "top-quality",
    "ajax-loader",
    "32x32.gif",
    "placeholder",
)

NON_PRODUCT_PATH_PARTS = (
    "cat/", "brand/", "label/", "cart", "checkout", "my-profile", "wp-content", "wp-json",
    "promocii", "kontakti", "contacts", "shop/page", "page/", "feed", "sitemap",
)

PLACEHOLDER_SKUS = ("няма", "n/a", "na")
SHOP_ROOT_CATEGORIES = ("магазин", "shop")

SCENT_WORDS = ("аромат", "мирис", "ухание", "fragrance", "scent")
COLOUR_WORDS = ("цвят", "color", "colour")
SIZE_WORDS = ("туба", "обем", "разфас", "лит", "мл", "ml", "л.", "kg", "кг", "гр", "g.")

TYPE_SCENT = "Аромат"
TYPE_COLOUR = "Цвят"
TYPE_SIZE = "Обем"
TYPE_OTHER = "Вариант"
STANDARD_VARIANT = "Стандартен"

CATEGORY_FRAGMENT = "/cat/"
PRODUCT_SITEMAP_PART = "product-sitemap"
CATEGORY_SITEMAP_PART = "product_cat"

TITLE_LIMIT = 500
NOTE_LIMIT = 700
NOTE_MIN_LENGTH = 10
LIST_ITEM_MIN_LENGTH = 4
MAX_NOTES = 6
MAX_IMAGES = 10
SKU_SUFFIX_LIMIT = 28
SITEMAP_INDEX = "sitemap_index"
SITEMAP_NAMES = r"(sitemap_index|product-sitemap)([0-9]*)[.]xml$"

RAW_COLUMNS = (
    "product_url", "listing_id", "seller_sku", "item_name", "category", "brand", "trademark",
    "variation_type_1", "variation_variant_1", "variation_type_2", "variation_variant_2",
    "item_notes", "item_description", "keyword_attributes", "images", "map_price",
    "net_content", "total_net_content", "net_content_unit", "availability", "raw_variation",
)

# feed column -> product row field, in sheet order
FEED_COLUMNS = {
    "listing_id": "listing_id",
    "seller_sku": "seller_sku",
    "item_name": "item_name",
    "category": "category",
    "reference_link": "product_url",
    "brand": "brand",
    "trademark": "trademark",
    "Variation_type_1": "variation_type_1",
    "Variation_Variants_1": "variation_variant_1",
    "Variation_type_2": "variation_type_2",
    "Variation_Variants_2": "variation_variant_2",
    "item_note": "item_notes",
    "item_description": "item_description",
    "Keyword_attributes": "keyword_attributes",
    "main_image_url": "images",
    "other_image_url": "images",
    "map_price": "map_price",
    "Net_content": "net_content",
    "Total_net_content": "total_net_content",
    "Net_content_unit": "net_content_unit",
}

FEED_EMPTY_COLUMNS = (
    "quantity", "item_length", "item_width", "item_height", "item_weight",
    "item_volume_unit", "item_weight_unit", "shipping_template",
)

# --- end of fixed values --------------------------------------------------
