"""Fixed values the generator draws from (names, places, catalogue with price bands)."""

FIRST_NAMES = [
    "Alex", "Taylor", "Jordan", "Morgan", "Casey", "Avery", "Jamie", "Riley", "Noah", "Emma",
    "Liam", "Olivia", "Ethan", "Sophia", "Mia", "Lucas", "Isabella", "Aiden", "Harper", "Amelia",
    "Daniel", "Chloe", "Ella", "Mason", "Zoe", "Levi", "Aria", "Logan", "Hannah", "Owen", "Luna",
]

LAST_NAMES = [
    "Smith", "Johnson", "Brown", "Garcia", "Lee", "Martinez", "Davis", "Kim", "Patel", "Anderson",
    "Miller", "Clark", "Wright", "Lopez", "Walker", "Hall", "Young", "Allen", "Scott", "Green",
    "Baker", "Adams",
]

CITIES = [
    "New York", "Los Angeles", "Chicago", "Toronto", "London", "Berlin", "Paris", "Amsterdam",
    "Sydney", "Singapore", "Dubai", "Tokyo", "Madrid", "Dublin", "Mumbai", "Sao Paulo",
    "Mexico City", "Cape Town",
]

EMAIL_DOMAINS = [
    "gmail.com", "yahoo.com", "outlook.com", "icloud.com", "proton.me", "examplemail.com",
]

PAYMENT_METHODS = [
    "Credit Card", "Debit Card", "PayPal", "Apple Pay", "Google Pay", "Bank Transfer",
    "Gift Card", "Cash on Delivery", "Buy Now, Pay Later",
]

# name, lowest and highest shipping price in dollars
COURIERS = [
    ("UPS", 4, 12),
    ("FedEx", 5, 18),
    ("DHL", 8, 22),
    ("USPS", 4, 10),
    ("Amazon Logistics", 3, 9),
    ("Regional Carrier", 5, 14),
]

# category -> (title, lowest and highest price in dollars)
CATALOGUE = {
    "electronics": [
        ("4K Smart TV 55-inch", 399, 899),
        ("Bluetooth Speaker", 29, 129),
        ("Wireless Earbuds", 49, 199),
        ("USB-C Hub 7-in-1", 24, 79),
        ("Laptop Stand", 25, 89),
    ],
    "clothing": [
        ("Classic Cotton T-Shirt", 15, 35),
        ("Premium Hoodie", 35, 95),
        ("Slim Fit Jeans", 30, 85),
        ("Running Shorts", 18, 45),
        ("Winter Jacket", 60, 180),
    ],
    "groceries": [
        ("Organic Coffee Beans 1lb", 12, 24),
        ("Extra Virgin Olive Oil 1L", 10, 22),
        ("Pasta Variety Pack", 8, 18),
        ("Protein Bars Box", 14, 32),
        ("Sparkling Water 12-pack", 6, 16),
    ],
    "home-appliances": [
        ("Air Fryer 5qt", 69, 179),
        ("Robot Vacuum", 149, 399),
        ("Blender", 39, 119),
        ("Espresso Machine", 129, 299),
        ("Compact Microwave", 89, 229),
    ],
    "beauty": [
        ("Hydrating Face Serum", 18, 48),
        ("Moisturizer", 15, 38),
        ("Eau de Parfum 50ml", 35, 120),
        ("Shampoo 500ml", 10, 28),
        ("Sunscreen SPF50", 12, 32),
    ],
    "books": [
        ("Business Strategy Hardcover", 18, 42),
        ("Mystery Novel Paperback", 12, 24),
        ("Productivity Journal", 14, 32),
        ("Cookbook Collection", 20, 44),
        ("Programming Handbook", 24, 60),
    ],
    "sports": [
        ("Yoga Mat", 18, 45),
        ("Resistance Bands Set", 15, 40),
        ("Insulated Water Bottle", 14, 32),
        ("Adjustable Dumbbell", 80, 220),
        ("Fitness Tracker", 49, 149),
    ],
    "mobile": [
        ("iPhone 15", 699, 999),
        ("Samsung Galaxy S24", 649, 949),
        ("Google Pixel 8", 549, 799),
        ("OnePlus 12", 599, 899),
        ("Moto G Power", 199, 329),
    ],
    "accessories": [
        ("Screen Protector 2-pack", 12, 28),
        ("Phone Case", 10, 35),
        ("USB-C Charging Cable", 9, 24),
        ("Portable SSD 1TB", 79, 149),
        ("Wireless Mouse", 19, 59),
    ],
    "furniture": [
        ("Ergonomic Office Chair", 129, 349),
        ("Standing Desk", 199, 499),
        ("Bookshelf", 59, 179),
        ("Coffee Table", 69, 199),
        ("Nightstand Set", 79, 189),
    ],
}

# products per category
OFFERS = 5
