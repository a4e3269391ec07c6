"""Small invented inputs for the jobs, as Python rows."""

import datetime as dt
import math

MODES = "i94mode,i94mode_label\n1,Air\n2,Sea\n3,Land\n9,Not Reported\n"
VISAS = "i94visa,i94visa_label\n1,Business\n2,Pleasure\n3,Student\n"

# code, name, state, relevance
PORTS = [
    ("LOS", "LOS ANGELES", "CA", "RELEVANT"),
    ("SFR", "SAN FRANCISCO", "CA", "RELEVANT"),
    ("NYC", "NEW YORK", "NY", "RELEVANT"),
    ("CLG", "CALGARY", "CANADA", "IRRELEVANT"),
    ("XXX", "NOT REPORTED", "", "IRRELEVANT"),
]
PORT_LABELS = "i94port,i94port_name,i94port_state,i94port_relevant\n" + "".join(
    ",".join(p) + "\n" for p in PORTS
)

# code, label, continent, global region
CITIZENSHIPS = [
    (264, "TURKEY", "ASIA", "NORTH"),
    (213, "INDIA", "ASIA", "SOUTH"),
    (135, "UNITED KINGDOM", "EUROPE", "NORTH"),
    (353, "TANZANIA, UNITED REPUBLIC OF", "AFRICA", "SOUTH"),
    (403, "INVALID: AMERICAN SAMOA", "INVALID", "INVALID"),
]
CITIZENSHIP_LABELS = (
    "i94cit,i94cit_label,i94cit_continent,i94cit_global_region\n"
    + "".join(f'{c},"{n}",{k},{g}\n' for c, n, k, g in CITIZENSHIPS)
)


def arrivals():
    """Every boundary value of each column, and one port with a third of all rows."""
    ages = [None, math.nan, -1.0, 0.0, 17.0, 18.0, 29.0, 30.0, 39.0, 40.0, 49.0]
    ages += [50.0, 59.5, 60.0, 120.0, 121.0]
    days = [20454.0, 20454.5, 20545.0, 0.0, -1.0, -0.5, None, math.nan]
    ports = ["LOS", "SFR", "NYC", "CLG", "XXX", "???", None]
    cits = [264.0, 213.0, 135.0, 353.0, 403.0, 999.0, None]
    modes = [1.0, 2.0, 3.0, 9.0, None]
    visas = [1.0, 2.0, 3.0, None]
    genders = ["M", "F", None, "U", "X", "m"]
    made = []
    for i in range(3000):
        made.append(
            {
                "i94cit": cits[(i * 5 + i // 7) % 7],
                "i94port": "LOS" if i % 3 == 0 else ports[(i // 3) % 7],
                "arrdate": days[(i * 3 + i // 11) % 8],
                "i94mode": modes[(i + i // 13) % 5],
                "i94visa": visas[(i + i // 17) % 4],
                "i94bir": ages[(i + i // 19) % 16],
                "gender": genders[(i + i // 23) % 6],
            }
        )
    return made


PORT_REGISTER = (
    "ident,type,name,iso_country,iso_region,municipality,iata_code\n"
    "A,small_airport,n,US,US-CA,Quincy,\n"
    "B,small_airport,n,US,US-CA,Quincy,QQQ\n"
    "C,heliport,n,US,US-CA,None,\n"
    "D,heliport,n,US,US-MA,Quincy,\n"
    "E,closed,n,US,US-U-A,Nowhere,\n"
    "F,large_airport,n,US,US,Bare,\n"
    "G,large_airport,n,US,,Blank,\n"
    "H,large_airport,n,GB,GB-CA,London,\n"
    "I,large_airport,n,US,US-NY,,NYC\n"
    "J,large_airport,n,US,US-NY,New York,NYC\n"
)

_HEAD = (
    "City;State;Median Age;Male Population;Female Population;Total Population;"
    "Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count\n"
)
RACES = [
    "Hispanic or Latino",
    "White",
    "Asian",
    "Black or African-American",
    "American Indian and Alaska Native",
]
CITIES = [
    ("Quincy", "Massachusetts", "39.0", 40, 50, 90, 4, 30, "2.5", "MA", RACES),
    ("Boston", "Massachusetts", "31.0", 300, 360, 660, 20, 200, "2.4", "MA", RACES[:4]),
    ("Quincy", "California", "35.0", 10, 12, 22, 1, 5, "0", "CA", RACES[:2]),
    ("Ames", "Iowa", "23.0", 30, 28, 58, "", 8, "", "IA", RACES[1:3]),
    ("Fresno", "California", "30.0", 250, 260, 510, 15, 110, "3.1", "CA", RACES),
]
DEMOGRAPHICS = _HEAD + "".join(
    ";".join(map(str, [*city[:10], race, 7 * i + len(city[0]) + city[3] % 5])) + "\n"
    for city in CITIES
    for i, race in enumerate(city[10])
)

_TEMPERATURES = [
    ("Boston", "United States", [1.0, 2.0, 10.0, 20.0], 2012),
    ("Boston", "United States", [3.0, None, 5.0], 2013),
    ("Quincy", "United States", [-4.5, 8.25, 8.25], 2012),
    ("New York", "United States", [7.0], 2012),
    ("Atlantis", "United States", [30.0, 31.0], 2012),
    ("London", "United Kingdom", [9.0], 2012),
]


def temperatures():
    return [
        (dt.date(year, month + 1, 1), value, city, country)
        for city, country, values, year in _TEMPERATURES
        for month, value in enumerate(values)
    ]


TEMPERATURE_FILE = (
    "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
    + "".join(
        f"{d},{'' if v is None else v},0.1,{c},{k},42.59N,72.00W\n"
        for d, v, c, k in temperatures()
    )
)
