"""Brand repair rules."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE_CLASS, blank, first_word, strip

# Category words that shops file under brand.
BRAND_DENYLIST = [
    "USB Cable", "Speaker", "Type-C Converter", "Keyboard", "Audio Cable",
    "USB Converter", "Network Accessories", "Scanner", "Document Printer",
    "Label Printers", "POS Printers", "Keyboard and Mouse Combo",
    "Studio Microphone", "POS and Label Supplies", "Power",
    "Conference System", "Bag", "Audio Converter", "Smart Door Bell",
    "Graphics Tablet PC", "Gaming Laptop", "Digital Display", "Smart",
    "Gaming Monitor", "Home Theater Systems", "Printer Paper", "Fridge",
    "Virtual Reality (VR)", "POS System", "Kitchen", "Armor", "Touch",
    "(Bundle", "PC", "Power Guard", "Tripod", "Cooler", "Compact Camera Accessories",
    "Lightning Converter", "Smart Lock", "Sound System Accessories",
    "Desktop Accessories", "All Monitor", "Compatible", "General",
    "TV Accessories", "Digital Signature Pad", "Tablet Accessories",
    "POS Accessories", "Digital", "June Server", "Audio Interface",
    "Gaming Desktop Component", "Gaming", "Gaming Network Router", "Super",
    "Television", "Internal SSD", "Microsoft Accessories", "All Laptop",
    "Video Camera", "Flash and Ring Light", "CR-80", "Ribbon", "3-Pin",
    "Earphone", "FAN", "Studio Equipments", "Studio Headphone", "A4",
    "Umbrella", "TP", "Accessories", "Mixer", "The", "Gaming Component",
    "Death", "A", "Exclusive", "Gadget", "HDMI", "VGA", "Weighing Scale",
    "Print Head", "Apple Tablet PC", "Home Care", "Space", "Projector",
    "Laser Printer", "Amplifier", "Casing", "PVC", "Processor",
    "Desktop and Server", "Pen Drive", "UPS", "(Single)",
    "Server Motherboard", "Server Processor", "Server Component",
]

# Words that mark a distributor, not a brand (`.` matches any character).
CORPORATE_WORDS = [
    "ltd", "limited", "corp", "corporation", "pvt", "llp", "gmbh",
    "l.l.c", "llc", "pharma", "pharmaceuticals", "pharmaceutica",
    "laboratories", "laboratoire", "distributors", "trading",
    "trade", "international", "plc",
]

# First words that need the second word to make a brand.
TITLE_WORDS = ["the", "dr.", "dr", "mr.", "mr", "miss", "mrs."]

# Brand cells that mean "none".
MISSING_BRANDS = ["nan", "no brand", "", ","]


def first_word_brand(name: Column) -> Column:
    return first_word(name)


def brand_from_denylist(brand: Column, name: Column) -> Column:
    """First word of the name where the brand is missing or a category word."""
    replaced = F.coalesce(first_word(name), brand)
    return F.when(brand.isNull() | brand.isin(BRAND_DENYLIST), replaced).otherwise(brand)


def is_missing_brand(brand: Column) -> Column:
    return F.lower(F.coalesce(strip(brand), F.lit(""))).isin(MISSING_BRANDS)


def is_corporate_brand(brand: Column) -> Column:
    words = "|".join(CORPORATE_WORDS)
    return F.coalesce(F.rlike(F.lower(brand), F.lit(rf"\b(?:{words})\b")), F.lit(False))


def fix_brand_name(brand: Column, name: Column) -> Column:
    """Keeps a plausible brand, else reads one from the start of the product name."""
    title = F.regexp_replace(strip(name), r"(?i)^Buy\s+[0-9]+\s+", "")
    words = F.regexp_extract_all(title, F.lit(rf"([^{SPACE_CLASS}]+)"), F.lit(1))
    first = _without_trailing_mark(F.get(words, F.lit(0)))
    second = _without_trailing_mark(F.get(words, F.lit(1)))
    from_name = (
        F.when(blank(title), F.lit("Unknown"))
        .when(F.lower(first).isin(TITLE_WORDS) & second.isNotNull(),
              F.concat(first, F.lit(" "), second))
        .otherwise(first)
    )
    return F.when(is_missing_brand(brand) | is_corporate_brand(brand), from_name
                  ).otherwise(strip(brand))


def _without_trailing_mark(word: Column) -> Column:
    return F.regexp_replace(word, r"[,:\-]\z", "")
