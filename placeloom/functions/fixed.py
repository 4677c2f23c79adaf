"""Tables and lists that results depend on. Plain text, in their natural order."""

# Fixed values. Categories: id | Russian | Kazakh | English. A parent is the id without its last part.
TAXONOMY = """
food | Еда и напитки | Тамақ және сусындар | Food & drink
food.cafe | Кафе | Кафе | Cafe
food.cafe.coffee_shop | Кофейня | Кофехана | Coffee shop
food.restaurant | Ресторан | Мейрамхана | Restaurant
food.fast_food | Фастфуд | Фастфуд | Fast food
food.bakery | Пекарня | Наубайхана | Bakery
food.bar | Бар | Бар | Bar
retail | Розница | Бөлшек сауда | Retail
retail.convenience | Мини-маркет | Шағын дүкен | Convenience store
retail.supermarket | Супермаркет | Супермаркет | Supermarket
retail.mall | Торговый центр | Сауда орталығы | Shopping mall
health | Здоровье | Денсаулық | Health
health.pharmacy | Аптека | Дәріхана | Pharmacy
health.clinic | Клиника | Емхана | Clinic
health.dentist | Стоматология | Стоматология | Dentist
health.hospital | Больница | Аурухана | Hospital
beauty | Красота | Сұлулық | Beauty
beauty.salon | Салон красоты | Сұлулық салоны | Beauty salon
beauty.barber | Барбершоп | Шаштараз | Barber
fitness | Спорт | Спорт | Sport
fitness.gym | Фитнес-клуб | Фитнес-клуб | Gym
education | Образование | Білім | Education
education.university | Университет | Университет | University
education.school | Школа | Мектеп | School
education.kindergarten | Детский сад | Балабақша | Kindergarten
finance | Финансы | Қаржы | Finance
finance.bank | Банк | Банк | Bank
finance.atm | Банкомат | Банкомат | ATM
transport | Транспорт | Көлік | Transport
transport.bus_stop | Остановка | Аялдама | Bus stop
transport.metro | Метро | Метро | Metro station
transport.rail | Вокзал | Вокзал | Railway station
office | Офисы | Кеңселер | Offices
office.business_center | Бизнес-центр | Бизнес-орталық | Business center
lodging | Проживание | Тұру | Lodging
lodging.hotel | Гостиница | Қонақүй | Hotel
"""

# Fixed values. Category of an open-data place: the source's category names, by ours.
PLACE_CATEGORIES = """
food.cafe.coffee_shop: coffee_shop coffee_or_tea_shop
food.cafe: cafe
food.restaurant: restaurant casual_eatery
food.fast_food: fast_food_restaurant burger_restaurant pizza_restaurant fast_food_or_quick_service_restaurant
food.bakery: bakery bakery_or_pastry_shop
food.bar: bar pub bar_or_pub
retail.convenience: convenience_store grocery_store grocery_or_convenience_store
retail.supermarket: supermarket
retail.mall: shopping_center shopping_mall
health.pharmacy: pharmacy drugstore pharmacy_or_drugstore
health.clinic: medical_center clinic doctor outpatient_care_facility medical_clinic
health.dentist: dentist dental_clinic dental_office
health.hospital: hospital
beauty.salon: beauty_salon nail_salon hair_salon beauty_salon_or_barber
beauty.barber: barber barber_shop barbershop
fitness.gym: gym fitness_center fitness_studio gym_or_fitness_center
education.university: college_university university college_or_university
education.school: school elementary_school high_school primary_or_secondary_school
education.kindergarten: preschool kindergarten childcare_or_preschool day_care_preschool
finance.bank: bank bank_or_credit_union
finance.atm: atm
transport.bus_stop: bus_station bus_stop
transport.metro: metro_station subway_station
transport.rail: train_station railway_station
lodging.hotel: hotel hostel
office.business_center: office_building corporate_or_business_office
"""

# Fixed values. Category of a tagged map object: the tags, by ours.
TAG_CATEGORIES = """
food.cafe: amenity=cafe
food.restaurant: amenity=restaurant
food.fast_food: amenity=fast_food
food.bar: amenity=bar amenity=pub
food.bakery: shop=bakery
retail.convenience: shop=convenience
retail.supermarket: shop=supermarket
retail.mall: shop=mall
health.pharmacy: amenity=pharmacy shop=chemist
health.clinic: amenity=clinic amenity=doctors
health.dentist: amenity=dentist
health.hospital: amenity=hospital
beauty.salon: shop=beauty
fitness.gym: leisure=fitness_centre
education.university: amenity=university amenity=college
education.school: amenity=school
education.kindergarten: amenity=kindergarten
finance.bank: amenity=bank
finance.atm: amenity=atm
transport.bus_stop: highway=bus_stop
transport.metro: railway=subway_entrance station=subway
transport.rail: railway=station
lodging.hotel: tourism=hotel
"""

# Fixed values. Tag keys in the order in which they are looked at, and those that make a named object a place.
TAG_KEYS = "amenity shop leisure tourism office healthcare railway station highway public_transport craft".split()
KEPT_KEYS = "amenity shop leisure tourism office healthcare craft".split()

# Fixed values. Russian and Kazakh letters in Latin script; none: dropped.
LETTERS = """
а a  б b  в v  г g  д d  е e  ё e  ж zh  з z  и i  й i  к k  л l  м m  н n  о o  п p  р r  с s  т t  у u
ф f  х h  ц ts  ч ch  ш sh  щ sh  ы y  э e  ю yu  я ya  ә a  ғ g  қ k  ң n  ө o  ұ u  ү u  һ h  і i
"""
SILENT_LETTERS = "ъь"

# Fixed values. Words that say nothing about which business it is.
LEGAL_FORMS = "тоо ип ао оао зао ооо чп кх жшс too llp llc ltd inc gmbh corp co jsc plc sa ltda kk".split()
GENERIC_WORDS = """
кафе кофейня кофе ресторан бар аптека магазин маркет минимаркет супермаркет пекарня салон красоты барбершоп фитнес клуб клиника
стоматология филиал центр торговый гипермаркет продукты дәріхана дүкен мейрамхана кофехана наубайхана емхана
cafe coffee shop restaurant pharmacy store market minimarket supermarket bakery salon beauty barbershop fitness club clinic
dental center centre branch the
""".split()
BRANCH = r"(?i)(?:#|№|no\.?\s*)\s*\d+|\b\d+\s*(?:филиал|branch)\b"

# Fixed values. Calling code and lengths of national numbers by country.
PHONE_RULES = {"KZ": ("7", (10,)), "RU": ("7", (10,)), "US": ("1", (10,)), "DE": ("49", (6, 7, 8, 9, 10, 11)), "AE": ("971", (8, 9)), "JP": ("81", (9, 10)), "BR": ("55", (10, 11))}

# Fixed values. Hosts of social networks, aggregators and link hubs.
SHARED_HOSTS = """
instagram.com facebook.com fb.com vk.com t.me wa.me whatsapp.com 2gis.kz 2gis.ru linktr.ee taplink.cc tiktok.com youtube.com
google.com goo.gl yandex.kz yandex.ru ok.ru twitter.com x.com
""".split()

# Fixed values. Categories that draw people; categories whose places may be nameless.
ANCHORS = "education.university education.school retail.mall office.business_center transport.metro transport.rail health.hospital".split()
NAMELESS = ("transport.", "finance.atm")

# Fixed values. Places' status by the source's.
STATUS = {"open": "open", "permanently_closed": "closed", "closed": "closed", "temporarily_closed": "temporarily_closed"}
AREA_LEVELS = {"region": "region", "locality": "city", "macrohood": "district"}
PRIORITIES = {"osm": 10, "overture_places": 20}

# Fixed values. Sources: id | name | license | attribution | commercial use | storage | share alike | how often | priority | license's address.
SOURCES = """
osm | OpenStreetMap (Geofabrik extracts) | ODbL-1.0 | © OpenStreetMap contributors | yes | yes | yes | daily (we ingest monthly) | 10 | https://www.openstreetmap.org/copyright
overture_places | Overture Maps — Places | CDLA-Permissive-2.0 | Overture Maps Foundation; contributors incl. Meta, Microsoft, Foursquare (Apache-2.0), AllThePlaces (CC0-1.0) | yes | yes | no | monthly | 20 | https://docs.overturemaps.org/attribution/
overture_divisions | Overture Maps — Divisions | ODbL-1.0 | © OpenStreetMap contributors, Overture Maps Foundation; geoBoundaries / Esri Community Maps (CC-BY-4.0) | yes | yes | yes | monthly | 20 | https://docs.overturemaps.org/attribution/
"""

# Fixed values. Weights by ring, and of the score's parts.
RING_WEIGHTS = (1.0, 0.6, 0.3)
SCORE_WEIGHTS = {"activity": 0.35, "anchors": 0.20, "competition": 0.20, "gap": 0.25}


def lines(block: str) -> list[list[str]]:
    return [[x.strip() for x in line.split("|")] for line in block.strip().splitlines()]


def inverted(block: str) -> dict[str, str]:
    return {name: ours for ours, _, names in (line.partition(": ") for line in block.strip().splitlines()) for name in names.split()}
