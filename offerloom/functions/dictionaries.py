"""Dictionaries of the offer pipeline.

Every table here is a block of fixed values: results depend on these exact
entries and, where a lookup takes the first hit, on their order. A key that maps
to itself is left out of maps whose default is the key.
"""

#: Brand keys that stand for another brand's key.
BRAND_ALIASES = {
    'MAYBELLINE NEW YORK': 'MAYBELLINE',
    'LOREAL': 'LOREAL PARIS',
    'L OREAL PARIS': 'LOREAL PARIS',
    'L OREAL': 'LOREAL PARIS',
    'LOREAL PROFESSIONNEL': 'LOREAL PARIS',
    'ESTEE LAUDER COMPANIES': 'ESTEE LAUDER',
    'NYX PROFESSIONAL MAKEUP': 'NYX',
    'NYX PROFESSIONAL': 'NYX',
    'MAC COSMETICS': 'MAC',
    'M.A.C': 'MAC',
    'M.A.C.': 'MAC',
    'BENEFIT COSMETICS': 'BENEFIT',
    'NARS COSMETICS': 'NARS',
    'DIOR BACKSTAGE': 'DIOR',
    'FENTY': 'FENTY BEAUTY',
    'PUPA MILANO': 'PUPA',
    'PASTEL PROFASHION': 'PASTEL',
    'SHOW BY PASTEL': 'PASTEL',
    'SHOW PASTEL': 'PASTEL',
    'REVOLUTION PRO': 'REVOLUTION',
    'MAKEUP REVOLUTION': 'REVOLUTION',
    'WET N WLD': 'WET N WILD',
    'WET AND WILD': 'WET N WILD',
    'KIKO MILANO': 'KIKO',
    'LANCME': 'LANCOME',
    'LANCÔME': 'LANCOME',
    'GIORGIO ARMANI': 'ARMANI',
    'ARMANI BEAUTY': 'ARMANI',
    'YVES SAINT LAURENT': 'YSL',
    'SAINT LAURENT': 'YSL',
    'VALENTINO BEAUTY': 'VALENTINO',
    'TARTE COSMETICS': 'TARTE',
    'SEPHORA': 'SEPHORA COLLECTION',
    'NOTE COSMETICS': 'NOTE',
    'ABH': 'ANASTASIA BEVERLY HILLS',
    'MAKEUP FOREVER': 'MAKE UP FOR EVER',
    'MILK': 'MILK MAKEUP',
    'PIXI BY PETRA': 'PIXI',
    'CHANEL BEAUTY': 'CHANEL',
    'DOLCE GABBANA': 'DOLCE & GABBANA',
    'DOLCE AND GABBANA': 'DOLCE & GABBANA',
    'E L F': 'E.L.F.',
    'ELF': 'E.L.F.',
    'ELF COSMETICS': 'E.L.F.',
    'ESSENCE COSMETICS': 'ESSENCE',
    'ESSENCE THE SKIN CARE': 'ESSENCE',
    'ETUDE HOUSE': 'ETUDE',
    'FLORMAR COLLECTION': 'FLORMAR',
    'LR ZEITGARD': 'LR',
    'MARUDERM.': 'MARUDERM',
    'MARU.DERM': 'MARUDERM',
}

#: Brand keys as they are shown.
BRAND_DISPLAY = {
    'MAYBELLINE': 'Maybelline',
    'LOREAL PARIS': "L'Oréal Paris",
    'ESTEE LAUDER': 'Estée Lauder',
    'CLINIQUE': 'Clinique',
    'FLORMAR': 'Flormar',
    'ESSENCE': 'Essence',
    'GOLDEN ROSE': 'Golden Rose',
    'NYX': 'NYX',
    'MAC': 'M·A·C',
    'BENEFIT': 'Benefit',
    'NARS': 'NARS',
    'DIOR': 'Dior',
    'CHARLOTTE TILBURY': 'Charlotte Tilbury',
    'FENTY BEAUTY': 'Fenty Beauty',
    'BOBBI BROWN': 'Bobbi Brown',
    'URBAN DECAY': 'Urban Decay',
    'TOO FACED': 'Too Faced',
    'CATRICE': 'Catrice',
    'PUPA': 'Pupa',
    'INGLOT': 'Inglot',
    'FARMASI': 'Farmasi',
    'PASTEL': 'Pastel',
    'REVOLUTION': 'Revolution',
    'WET N WILD': 'Wet n Wild',
    'MISSHA': 'Missha',
    'KIKO': 'KIKO',
    'PIERRE CARDIN': 'Pierre Cardin',
    'CATHERINE ARLEY': 'Catherine Arley',
    'THE PUREST SOLUTIONS': 'The Purest Solutions',
    'YVES ROCHER': 'Yves Rocher',
    'NIVEA': 'Nivea',
    'SHISEIDO': 'Shiseido',
    'LANCOME': 'Lancôme',
    'GUERLAIN': 'Guerlain',
    'ARMANI': 'Armani Beauty',
    'YSL': 'Yves Saint Laurent',
    'SISLEY': 'Sisley',
    'GIVENCHY': 'Givenchy',
    'VALENTINO': 'Valentino Beauty',
    'HUDA BEAUTY': 'Huda Beauty',
    'RARE BEAUTY': 'Rare Beauty',
    'TARTE': 'Tarte',
    'SEPHORA COLLECTION': 'Sephora Collection',
    'HOURGLASS': 'Hourglass',
    'BELL': 'Bell',
    'GABRINI': 'Gabrini',
    'CALLISTA': 'Callista',
    'NASCITA': 'Nascita',
    'NOTE': 'NOTE',
    'ANASTASIA BEVERLY HILLS': 'Anastasia Beverly Hills',
    'MAKE UP FOR EVER': 'Make Up For Ever',
    'NUDESTIX': 'Nudestix',
    'MILK MAKEUP': 'Milk Makeup',
    'PIXI': 'Pixi',
    'AVON': 'Avon',
    'CHANEL': 'Chanel',
    'CLARINS': 'Clarins',
    'DOLCE & GABBANA': 'Dolce & Gabbana',
    'CAUDALIE': 'Caudalie',
    'NUXE': 'Nuxe',
    'VIVIENNE SABO': 'Vivienne Sabo',
    'WONDERWAY': 'Wonderway',
    'LYKD': 'LYKD',
    'COLOURPOP': 'ColourPop',
    'E.L.F.': 'e.l.f.',
    'LANEIGE': 'Laneige',
    'ETUDE': 'Etude',
    'INNISFREE': 'Innisfree',
    'BABYFACE': 'Babyface',
    'BEAULIS': 'Beaulis',
    'LUSS': 'Luss',
    'SKINFOOD': 'Skinfood',
    'KUATRA': 'Kuatra',
    'JOWE': 'Jowe',
    'COLORGRAM': 'Colorgram',
    'LR': 'LR',
    'MUSON': 'Muson',
    'WONDERSKIN': 'Wonderskin',
    'HOMM LIFE': 'Homm Life',
    'BIOAQUA': 'Bioaqua',
    'VERACLARA': 'Veraclara',
    'FOCALLURE': 'Focallure',
    'TTT': 'TTT',
    'MARUDERM': 'Maru.Derm',
}

#: Brands that are looked for in names, the longest first.
KNOWN_BRANDS = (
    'Maybelline New York', 'NYX Professional Makeup', 'Make Up For Ever', "L'Oréal Paris", "L'Oreal Paris", "L'Oréal", "L'Oreal", 'Anastasia Beverly Hills',
    'Anastasıa Beverly Hills', 'Charlotte Tilbury', 'Yves Saint Laurent', 'Yves Rocher', 'The Purest Solutions', 'Fenty Beauty', 'Huda Beauty', 'Rare Beauty',
    'Dolce & Gabbana', 'Urban Decay', 'Too Faced', 'Bobbi Brown', 'NARS Cosmetics', 'Giorgio Armani', 'Armani Beauty', 'Sephora Collection',
    'Benefit Cosmetics', 'Revolution Pro', 'Makeup Revolution', 'Pastel Profashion', 'Show By Pastel', 'Show by Pastel', 'Kiko Milano', 'KIKO Milano',
    'KIKO', 'Pupa Milano', 'Pierre Cardin', 'Catherine Arley', 'Wet n Wild', 'Wet N Wild', 'Vivienne Sabo', 'Golden Rose',
    'ColourPop', 'Colourpop', 'Pixi by Petra', 'Alix Avien', 'ALIX AVIEN', 'New Well', 'NEW WELL', 'Jane Iredale',
    'JANE IREDALE', 'Bade Natural', 'BADE NATURAL', 'Max Factor', 'MAX FACTOR', 'Physicians Formula', 'Diego Dalla Palma', 'TCA Studio Make-Up',
    'TCA STUDIO MAKE-UP', 'TCA Studio', 'Pretty Beauty', 'PRETTY BEAUTY', 'Sweet Kiss', 'SWEET KISS', 'Naj Oleari', 'NAJ OLEARI',
    'Pop Beauty', 'POP BEAUTY', 'Estée Lauder', 'Estee Lauder', 'ESTÉE LAUDER', 'Deborah Milano', 'DEBORAH MILANO', 'Dilara Zeybek',
    'Cream Co.', 'CREAM CO.', 'Merit Flush', 'Lionesse Silver', 'Nivea Sun', 'NIVEA SUN', 'Laura Mercier', 'Smashbox Cosmetics',
    'Becca Cosmetics', 'Pat McGrath', 'Maybelline', 'Flormar', 'Essence', 'Catrice', 'NOTE', 'Pastel',
    'NYX', 'MAC', 'Clinique', 'Benefit', 'NARS', 'Dior', 'Farmasi', 'Inglot',
    'Revolution', 'Pupa', 'Revlon', 'Rimmel', 'Shiseido', 'Armani', 'Lancôme', 'Lancome',
    'Guerlain', 'YSL', 'rom&nd', 'Astra', 'Missha', 'Tarte', 'Sisley', 'Clarins',
    'Givenchy', 'Valentino', 'Nudestix', 'Pixi', 'Kosas', 'Hourglass', 'Chanel', 'Kiko',
    'Bell', 'Callista', 'Nascita', 'Gabrini', 'Avon', 'Wonderway', 'LYKD', 'Lykd',
    'Isana', 'Alterra', 'Etude', 'Laneige', 'Innisfree', 'Caudalie', 'Nuxe', 'Milani',
    'E.L.F.', 'Colorgram', 'Jowe', 'Wonderskin', 'Bioaqua', 'Veraclara', 'Focallure', 'Beaulis',
    'Homm Life', 'Muson', 'LR Zeitgard', 'Oriflame', 'Nivea', 'NIVEA', 'Deborah', 'Smashbox',
    'Becca', 'Stila', 'Bourjois', 'Neutrogena', 'Bioderma', 'Vichy', 'Garnier', 'La Roche-Posay',
    'The Ordinary', 'Wella', 'Dove', 'Monteil', 'Lionesse', 'Merit', 'Peripera', 'Handaiyan',
    'Sheglam', 'SHEGLAM', 'O.TWO.O', 'Lumene', 'LUMENE', 'MOV', 'Extreme', 'Infaillible',
)

#: Parts of names that tell a brand, in order.
LINE_TO_BRAND = {
    'infaillible': "L'Oréal Paris",
    'true match': "L'Oréal Paris",
    'fit me': 'Maybelline',
    'superstay': 'Maybelline',
    'sky high': 'Maybelline',
    'lash sensational': 'Maybelline',
    'double wear': 'Estée Lauder',
    'stay in place': 'Estée Lauder',
    'teint idole': 'Lancôme',
    'backstage': 'Dior',
    'air blush': 'NARS',
    'matte trance': 'NARS',
    'telescopic': "L'Oréal Paris",
    'accord parfait': "L'Oréal Paris",
    'lifter': 'Maybelline',
    'brow up': 'Flormar',
    'colorgram': 'Colorgram',
    'jowe': 'Jowe',
}

#: Category labels and their normal form.
CATEGORY_LABELS = {
    'Fondoten': 'Fondöten',
    'Goz Fari': 'Göz Farı',
    'Goz Kalemi': 'Göz Kalemi',
    'Allik': 'Allık',
    'Aydinlatici': 'Aydınlatıcı',
    'Kontur': 'Kontür',
    'Kapatici': 'Kapatıcı',
    'Dudak Parlatici': 'Dudak Parlatıcı',
    'Kas Makyaji': 'Kaş Makyajı',
    'Kas Kalemi': 'Kaş Kalemi',
    'Kas Fari': 'Kaş Farı',
    'Kas Sabitleyici': 'Kaş Sabitleyici',
    'BB CC Krem': 'BB & CC Krem',
    'Vucut Simi': 'Vücut Simi',
    'Gunes Koruyucu': 'Güneş Koruyucu',
    'Goz Kremi': 'Göz Kremi',
    'Dus Jeli': 'Duş Jeli',
    'Vucut Losyonu': 'Vücut Losyonu',
    'Parfum': 'Parfüm',
}

#: Labels of categories.
LABEL_OF_CATEGORY = {
    'fondoten': 'Fondöten',
    'maskara': 'Maskara',
    'ruj': 'Ruj',
    'far': 'Göz Farı',
    'far-paleti': 'Far Paleti',
    'eyeliner': 'Eyeliner',
    'goz-kalemi': 'Göz Kalemi',
    'allik': 'Allık',
    'aydinlatici': 'Aydınlatıcı',
    'bronzer': 'Bronzer',
    'kontur': 'Kontür',
    'kapatici': 'Kapatıcı',
    'primer': 'Primer',
    'pudra': 'Pudra',
    'dudak-parlatici': 'Dudak Parlatıcı',
    'dudak-kalemi': 'Dudak Kalemi',
    'kas': 'Kaş Makyajı',
    'dipliner': 'Dipliner',
    'kas-kalemi': 'Kaş Kalemi',
    'kas-fari': 'Kaş Farı',
    'kas-sabitleyici': 'Kaş Sabitleyici',
    'bb-cc-krem': 'BB & CC Krem',
    'makyaj-sabitleyici': 'Makyaj Sabitleyici',
    'makyaj-seti': 'Makyaj Seti',
    'vucut-simi': 'Vücut Simi',
    'nemlendirici': 'Nemlendirici',
    'vucut-losyonu': 'Vücut Bakımı',
    'parfum': 'Parfüm',
    'goz-kremi': 'Göz Kremi',
}

#: Categories that stand for another one.
CATEGORY_NAMES = {
    'ruj-likit': 'ruj',
}

#: Fixed values: (category, parts of names) in order; the first hit decides.
CATEGORY_RULES = (
    ('maskara', ('maskara', 'mascara', 'rimel', 'kirpik', 'lash sensational', 'sky high', 'colossal', 'lash princess', 'bambi', 'lash blasté', "they're real", 'bad gal', 'roller lash', 'fan fest',)),
    ('dipliner', ('dipliner', 'dip liner', 'likit eyeliner', 'liquid liner', 'likit liner',)),
    ('eyeliner', ('eyeliner', 'eye liner', 'kajal liner', 'gel liner', 'waterproof liner', 'mat liner', 'otomatik jel', 'infaillible liner', 'precision liner',)),
    ('goz-kalemi', ('göz kalemi', 'goz kalemi', 'eye pencil', 'kohl pencil', 'kayal', 'kajal pencil',)),
    ('far-paleti', ('far paleti', 'palette', 'paleti', 'eyeshadow palette', 'shadow palette',)),
    ('far', ('göz farı', 'goz fari', 'eye shadow', 'eyeshadow', 'far ', ' far', 'stick far', 'shimmer shadow',)),
    ('fondoten', ('fondöten', 'fondoten', 'foundation', 'fond\\s', 'skin glow foundation', 'skin foundation', 'fluid foundation', 'cushion',)),
    ('kapatici', ('kapatıcı', 'kapatici', 'concealer', 'conceal', 'touch eclat', 'corrector',)),
    ('allik', ('allık', 'allik', 'blush', 'rouge joue',)),
    ('aydinlatici', ('aydınlatıcı', 'aydinlatici', 'highlighter', 'illuminator', 'strobing', 'glow',)),
    ('bronzer', ('bronzer', 'bronz', 'terracotta',)),
    ('kontur', ('kontür', 'kontur', 'contour', 'sculpt',)),
    ('pudra', ('pudra', 'powder', 'loose powder', 'fixing powder', 'toz pudra', 'compact powder',)),
    ('bb-cc-krem', ('bb krem', 'bb cream', 'cc krem', 'cc cream', 'bb & cc', 'bb&cc', 'bb ve cc',)),
    ('makyaj-sabitleyici', ('setting spray', 'makyaj sabitleyici sprey', 'fixing spray', 'fixer spray', 'sabitleyici sprey', 'fix spray',)),
    ('primer', ('primer', 'makyaj bazı', 'makeup base', 'pore filler', 'sabitleyici', 'setting spray', 'baz ',)),
    ('ruj', ('ruj', 'lipstick', 'lip stick', 'likit mat ruj', 'lip cream', 'lip balm', 'lip color', 'rouge à lèvres',)),
    ('dudak-parlatici', ('dudak parlatıcı', 'dudak parlatici', 'lip gloss', 'lipgloss', 'lip glaze', 'lip oil',)),
    ('dudak-kalemi', ('dudak kalemi', 'lip liner', 'lipliner', 'lip pencil',)),
    ('kas-kalemi', ('kaş kalemi', 'kas kalemi', 'eyebrow pencil', 'brow pencil', 'kaş şekillendirici', 'brow shaper', 'brow definer',)),
    ('kas-fari', ('kaş farı', 'kas fari', 'eyebrow powder', 'brow powder', 'kaş tozu',)),
    ('kas-sabitleyici', ('kaş sabitleyici', 'kas sabitleyici', 'kaş jeli', 'brow gel', 'kaş maskara', 'brow mascara', 'brow pomade', 'kaş pomad',)),
    ('kas', ('kaş', 'kas', 'brow', 'eyebrow',)),
    ('makyaj-seti', ('makyaj seti', 'makeup set', 'beauty set', 'makeup kit', 'makyaj kit',)),
    ('vucut-simi', ('vücut simi', 'vucut simi', 'body shimmer', 'body glitter', 'vücut parıltı', 'body glow', 'vücut ışıltı',)),
)

#: Categories that may stand for each other in matching.
COMPATIBLE_CATEGORIES = (
    ('eyeliner', 'goz-kalemi'),
    ('far', 'far-paleti'),
    ('far', 'goz-kalemi'),
    ('far', 'eyeliner'),
)

#: Words of product names and the word that they are compared as.
SYNONYMS = {
    'maskara': 'mascara',
    'fondoten': 'foundation',
    'fondöten': 'foundation',
    'ruj': 'lipstick',
    'allık': 'blush',
    'allik': 'blush',
    'aydınlatıcı': 'highlighter',
    'aydinlatici': 'highlighter',
    'kapatıcı': 'concealer',
    'kapatici': 'concealer',
    'kirpik': 'lash',
    'dudak': 'lip',
    'göz': 'eye',
    'goz': 'eye',
    'kalemi': 'pencil',
    'kalem': 'pencil',
    'hacim': 'volume',
    'uzatıcı': 'lengthening',
    'uzatici': 'lengthening',
    'parlak': 'glossy',
    'mat': 'matte',
    'kremsi': 'creamy',
    'suya': 'water',
    'dayanıklı': 'resistant',
    'dayanikli': 'resistant',
    'kıvrım': 'curl',
    'kivrim': 'curl',
    'kıvırma': 'curl',
    'nemlendirici': 'moisturizing',
    'yaşlanma': 'anti-aging',
    'yaslanma': 'anti-aging',
    'karşıtı': 'anti',
    'karsiti': 'anti',
    'bakım': 'care',
    'bakim': 'care',
    'fırınlanmış': 'baked',
    'firinlanmis': 'baked',
    'ışıltılı': 'shimmery',
    'isiltili': 'shimmery',
    'işıltılı': 'shimmery',
    'likit': 'liquid',
    'toz': 'powder',
    'pudra': 'powder',
    'kalıcı': 'long-lasting',
    'kalici': 'long-lasting',
    'doğal': 'natural',
    'dogal': 'natural',
    'formüllü': 'formula',
    'formullu': 'formula',
    'veren': 'giving',
    'etkili': 'effect',
    'sınırsız': 'limitless',
    'sinirsiz': 'limitless',
    'aşırı': 'extreme',
    'asiri': 'extreme',
    'yoğun': 'intense',
    'yogun': 'intense',
    'dolgunlaştırıcı': 'plumping',
    'sabitleyici': 'setting',
    'sıkılaştırıcı': 'firming',
    'buğulu': 'smoky',
    'kadifemsi': 'velvety',
    'kadife': 'velvet',
    'takma': 'false',
    'kompakt': 'compact',
    'paleti': 'palette',
    'palet': 'palette',
    'farı': 'shadow',
    'fari': 'shadow',
    'uzunluk': 'length',
    'uzunluğu': 'length',
}

#: Product lines in the order in which they are looked for.
PRODUCT_LINES = (
    'perfect coverage', 'skin lifting', 'volume up', 'longer than ever', 'spider lash', 'hero volume', 'false lash', 'sheer up',
    'cc cream', 'invisible cover', 'extreme tattoo', 'baked blush', 'stay perfect', 'mood booster', 'waterproof eyeliner', 'waterproof lipliner',
    'midnight matte', 'smoky eyes', 'brow up', 'precious curl', 'triple action', 'open up', 'big n bold', 'carefull volume',
    'set n go', 'setn go', 'lightweight lip powder', 'water lip stain', 'shine kiss', 'creamy stylo', 'puffy liquid', 'hd foundation',
    'moisture touch', 'matte perfection', 'total cover', 'dream eyes', 'velvet matte', 'soft color', 'smart glow', 'strobing',
    'dipliner', 'longstay liquid matte', 'super stay', 'superstay', 'fit me', 'instant age rewind', 'lash sensational', 'colossal',
    'curl bounce', 'sky high', 'master chrome', 'color sensational', 'vinyl ink', 'eraser eye', 'the falsies', 'infallible',
    'true match', 'telescopic', 'paradise', 'bambi eye', 'color riche', 'age perfect', 'mega volume', 'double wear',
    'even better', 'beyond perfecting', 'studio fix', 'prep prime', 'retro matte', 'better than sex', 'damn girl', 'born this way',
    'lash princess', 'pure nude', 'longlasting eye pencil', 'hello good stuff', 'skin tint', 'hd liquid coverage', 'one drop coverage', 'glam and doll',
    'lip lingerie', 'soft matte', 'butter gloss', 'born to glow', 'wonder stick', 'cant stop', 'detox protect', 'mattemoist',
    'long wearing', 'ultra rich', 'conceal protect', 'mineral', 'icon', 'luminous silk', 'power fabric', 'neo nude',
    'touche eclat', 'all hours', 'tatouage couture', 'forever skin', 'backstage', 'addict', 'rouge dior', 'diorshow',
    'diorskin', 'show your', 'profashion', 'magic khol', 'conceal and define', 'skin silk', 'stay matte', 'lasting finish',
    'the only one', 'precisely my brow', 'gimme brow', 'fan fest', 'bad gal', 'hoola', 'roller lash', 'cookie',
    'dandelion', 'cheeky', 'boi ing', 'real magnet', 'they re real', 'watt s up', 'pillow talk', 'airbrush flawless',
    'magic away', 'beautiful skin', 'flawless filter', 'magic powder', 'positive light', 'liquid touch', 'soft pinch', 'stay vulnerable',
    'find comfort', 'kind words', 'with gratitude', 'natural radiant', 'sheer glow', 'radiant creamy', 'soft matte complete', 'orgasm',
    'laguna', 'blush', 'all nighter', 'naked', 'original', 'honey', 'vice', 'pro filtr',
    'eaze drop', 'match stix', 'killawatt', 'gloss bomb', 'teint idole', 'miracle blur', 'hypnose', 'monsieur big',
    'juicy tubes', 'absolu', 'maxi', 'designer lift', 'lip maestro', 'air volume', 'mega length', 'color elixir',
    'rouge velvet', 'brow this way', 'i love extreme', 'i love crazy', 'lash like wow', 'contouring', 'all about matt', 'sun glow',
)

#: Words that tell no products apart.
GENERIC_WORDS = (
    'mascara', 'lipstick', 'foundation', 'blush', 'eyeliner', 'eyeshadow', 'concealer', 'highlighter',
    'powder', 'primer', 'bronzer', 'contour', 'pencil', 'lash', 'lip', 'eye',
    'volume', 'matte', 'glossy', 'liquid', 'cream', 'gel', 'stick', 'baked',
    'compact', 'pressed', 'moisturizing', 'natural', 'effect', 'giving', 'formula', 'waterproof',
    'long-lasting', 'creamy', 'shimmer', 'shimmery', 'yüksek', 'pigmentli', 'bitişli', 'yapılı',
    'dokulu', 'suya', 'resistant', 'anti', 'care', 'spf', 'spf15', 'spf20',
    'spf30',
)

#: Skin types by category; others are normal.
SKIN_TYPES = {
    'fondoten': ('normal', 'karma',),
    'kapatici': ('normal', 'karma', 'yagli',),
    'primer': ('yagli', 'karma',),
    'allik': ('normal', 'kuru', 'karma',),
    'aydinlatici': ('kuru', 'normal',),
    'bronzer': ('normal', 'karma',),
    'kontur': ('normal', 'karma',),
    'pudra': ('yagli', 'karma',),
    'maskara': ('normal', 'kuru', 'karma',),
    'far': ('normal', 'kuru', 'karma',),
    'far-paleti': ('normal', 'kuru', 'karma',),
    'eyeliner': ('yagli', 'karma',),
    'goz-kalemi': ('normal', 'karma',),
    'ruj': ('kuru', 'normal',),
    'dudak-parlatici': ('kuru', 'normal',),
    'dudak-kalemi': ('normal', 'karma',),
    'kas': ('normal', 'karma',),
    'dipliner': ('yagli', 'karma',),
    'kas-kalemi': ('normal', 'karma',),
    'kas-fari': ('normal', 'kuru', 'karma',),
    'kas-sabitleyici': ('yagli', 'karma',),
    'bb-cc-krem': ('normal', 'kuru', 'karma',),
    'makyaj-sabitleyici': ('yagli', 'karma',),
    'makyaj-seti': ('normal', 'kuru', 'karma', 'yagli',),
    'vucut-simi': ('normal', 'kuru', 'karma',),
    'nemlendirici': ('kuru', 'normal', 'karma',),
    'serum': ('normal', 'kuru', 'karma', 'yagli',),
    'gunes-koruyucu': ('normal', 'kuru', 'karma', 'yagli', 'hassas',),
    'cilt-temizleme': ('normal', 'karma', 'yagli',),
    'tonik': ('normal', 'karma', 'yagli',),
    'goz-kremi': ('kuru', 'normal',),
    'cilt-maskesi': ('normal', 'kuru', 'karma',),
    'peeling': ('normal', 'karma', 'yagli',),
    'dus-jeli': ('normal', 'kuru', 'karma',),
    'vucut-losyonu': ('kuru', 'normal',),
    'parfum': ('normal', 'kuru', 'karma',),
}

#: Pairs of products known as substitutes: brand and part of the name of one, then of the other.
SUBSTITUTES = (
    ('CHARLOTTE TILBURY', 'flawless filter', 'E.L.F.', 'halo glow'),
    ('DIOR', 'lip glow oil', 'NYX', 'fat oil'),
    ('ESTEE LAUDER', 'double wear', 'MAYBELLINE', 'super stay'),
    ('NARS', 'radiant creamy', 'MAYBELLINE', 'fit me'),
    ('FENTY BEAUTY', 'gloss bomb', 'MAYBELLINE', 'lifter gloss'),
    ('CLINIQUE', 'black honey', 'E.L.F.', 'black cherry'),
    ('TARTE', 'shape tape', 'LOREAL PARIS', 'infallible'),
)

#: Sellers in order of priority, and sellers in order of the quality of their images.
SELLERS = ('Trendyol', 'Gratis', 'Rossmann', 'YvesRocher', 'Hepsiburada', 'Amazon', 'Idefix', 'Pazarama', 'PttAvm')
IMAGE_SELLERS = ('Sephora', 'Trendyol', 'Gratis', 'Watsons', 'Rossmann')

#: Colours that count as shade codes.
COLOUR_CODES = ('siyah', 'kahverengi', 'bordo', 'pembe', 'kırmızı', 'turuncu', 'mor', 'mavi', 'yeşil', 'bej', 'nude', 'black', 'brown', 'blue', 'red', 'pink', 'coral', 'berry', 'burgundy', 'ivory', 'sand', 'honey', 'vanilla', 'porcelain', 'bronze', 'taupe', 'warm', 'cool', 'light', 'medium', 'dark', 'fair')

#: Colours after a number that end a name's core.
NUMBERED_COLOURS = ('light', 'dark', 'medium', 'soft', 'warm', 'cool', 'nude', 'beige', 'ivory', 'rose', 'golden', 'natural', 'honey', 'pure', 'sand', 'caramel', 'vanilla', 'cream', 'porcelain', 'tan', 'mocha', 'cocoa', 'toffee', 'amber', 'chestnut', 'mahogany', 'espresso', 'bronze', 'coral', 'pink', 'red', 'berry', 'plum', 'mauve', 'peach', 'apricot', 'cinnamon', 'sienna', 'almond', 'bisque', 'buff', 'linen', 'ecru', 'champagne', 'fawn', 'hazel', 'khaki', 'olive', 'sage', 'taupe', 'umber', 'wheat', 'bisque', 'burgundy', 'siyah', 'kahve', 'pembe', 'krem', 'bej', 'bal')

#: Colours and tones that are no part of a name's core.
CORE_COLOURS = ('siyah', 'kahverengi', 'bordo', 'pembe', 'kırmızı', 'turuncu', 'mor', 'mavi', 'yeşil', 'bej', 'nude', 'black', 'brown', 'blue', 'red', 'pink', 'pinky', 'coral', 'berry', 'burgundy', 'bordeaux', 'intense black', 'ekstra siyah', 'gaia', 'ivory', 'sand', 'honey', 'vanilla', 'rose', 'golden', 'porcelain', 'amber', 'bronze', 'hazel', 'olive', 'taupe', 'wheat', 'cocoa', 'mocha', 'toffee', 'caramel', 'bisque', 'peach', 'apricot', 'mauve', 'plum', 'sienna', 'cinnamon', 'espresso', 'mahogany', 'chestnut', 'champagne', 'linen', 'ecru', 'buff', 'fawn', 'khaki', 'sage', 'umber', 'cool', 'warm', 'light', 'dark', 'medium', 'deep', 'fair', 'natural', 'soft', 'true', 'pure', 'original', 'cherry', 'sunset', 'dusty', 'vintage', 'classic', 'timeless', 'innocent', 'rosy', 'daring', 'enchanted')
CORE_TONES = ('baby girl', 'pinky nude', 'enchanted kiss', 'daring whisper', 'rosy lust', 'rosewood', 'creamy sand', 'honey glow', 'sunset coral', 'cherry blossom', 'dusty rose', 'go for', 'whisper', 'kiss', 'girl', 'poise', 'lust')

#: Colours that are no part of a product line.
LINE_COLOURS = ('siyah', 'kahverengi', 'bordo', 'pembe', 'kırmızı', 'turuncu', 'mor', 'mavi', 'yeşil', 'bej', 'nude', 'black', 'brown', 'blue', 'red', 'pink', 'coral', 'berry', 'burgundy')

#: Spellings joined to one word (a pattern, its word).
COMPOUNDS = ((r'\blip\s*stick', 'lipstick'), (r'\beye\s*liner', 'eyeliner'), (r'\beye\s*shadow', 'eyeshadow'), (r'\blip\s*gloss', 'lipgloss'), (r'\blip\s*liner', 'lipliner'), (r'\bblush[\s-]*on', 'blush'))

#: What the quality filter looks for, by the rule's name.
STORE_WORDS = ('fırsat', 'mağaza', 'market', 'indirim', 'kampanya')
CATALOGUE_WORDS = ('fiyatlar', 'markalar', 'çeşitler', 'modelller', 'renkleri', 'yorumlar', 'cesitler', 'fiyatlari', 'markalari')
BANNER_WORDS = ('keşfet', 'yakalayın', 'ayrıcalıklı', 'özel fiyat', 'kampanya')
GIFT_WORDS = ('hediye seti', 'hediye set', 'avantaj paketi', 'avantajlı paket', 'deneme boy', 'kofre', 'coffret', 'promosyon', 'kutu boy', 'çanta boy', 'özel kutu')
CAR_WORDS = ('ford', 'volkswagen', 'vw', 'renault', 'toyota', 'honda', 'bmw', 'mercedes', 'audi', 'opel', 'fiat', 'hyundai', 'kia', 'peugeot', 'citroen', 'seat', 'skoda', 'volvo', 'passat', 'focus', 'corolla', 'civic', 'golf', 'polo', 'mais')
OTHER_GOODS = ('led far', 'xenon', r'oto\s', 'otomobil', 'araç', 'araba', 'motor', 'motosiklet', 'ampul', 'silecek', 'bisiklet', 'koşu bandı', 'çadır', 'spor aleti', 'dambıl', 'halter', 'kondisyon', 'çanta', 'cüzdan', 'valiz', 'şemsiye', 'tarak', 'törpü', 'cımbız', 'yastık', 'yorgan', 'battaniye', 'havlu', 'bornoz', 'aksesuar', 'ocak', 'fırın', 'çamaşır', 'bulaşık', 'süpürge', 'aspiratör', 'klima', 'televizyon', 'telefon kart', 'laptop', 'tablet', 'kulaklık', 'hoparlör', 'şarj', 'kablo', 'pil ', 'halı', 'perde', 'tencere', 'tava', 'tabak', 'bardak', 'çatal', 'kaşık', 'bıçak', 'elektrikli', 'kontör', 'ps4', 'ps5', 'xbox', 'playstation', 'nintendo', 'oyun kulaklık', 'penis', 'anal', 'vibrat')
CLOTHES = ('termal', 'fanila', 'korse', 'atlet', 'tayt', 'boxer', 'külot', 'çorap', 'pantolon', 'gömlek', 'tişört', 't-shirt', 'sweatshirt', 'mont', 'ceket', 'palto', 'elbise', 'etek', 'şort')

#: Signs of categories; others have the last one.
CATEGORY_SIGNS = {
    'fondoten': '✨', 'kapatici': '💫', 'primer': '🌟', 'allik': '🌸', 'aydinlatici': '💡', 'bronzer': '🌞', 'kontur': '🎭', 'pudra': '🌿', 'maskara': '👁️', 'far': '💜', 'far-paleti': '🎨', 'eyeliner': '✏️',
    'goz-kalemi': '🖊️', 'ruj': '💄', 'dudak-parlatici': '✨', 'dudak-kalemi': '🖊️', 'dipliner': '✏️', 'kas-kalemi': '✒️', 'kas-fari': '🤎', 'kas-sabitleyici': '🌿', 'bb-cc-krem': '💧', 'makyaj-sabitleyici': '💨', 'makyaj-seti': '🎁', 'vucut-simi': '✨',
}
OTHER_SIGN = '💄'

#: Parts of urls that tell a category, in order, and parts of urls of make-up.
URL_CATEGORIES = {
    '/nemlendirici/': 'nemlendirici', '/serum/': 'serum', '/gunes-koruyucu/': 'gunes-koruyucu', '/temizleme/': 'cilt-temizleme', '/tonik/': 'tonik', '/goz-kremi/': 'goz-kremi', '/maske/': 'cilt-maskesi',
    '/peeling/': 'peeling', '/krem/': 'nemlendirici', '/cilt-bakimi/': 'nemlendirici', '/parfum/': 'parfum', '/dus-jeli/': 'dus-jeli', '/vucut-losyonu/': 'vucut-losyonu', '/vucut-bakimi/': 'vucut-losyonu',
}
MAKE_UP_URLS = ('/makyaj/', '/ten-makyaji/', '/dudak-makyaji/', '/goz-makyaji/')
