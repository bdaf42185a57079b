"""Fixed values that the feed's tables must carry: publishers, colours, names and separators."""

from __future__ import annotations

#: agency_id, agency_name, agency_url; time zone and language are the same for all.
AGENCIES = [
    ("KMB", "Kowloon Motor Bus", "https://kmb.hk"),
    ("CTB", "Citybus", "https://www.citybus.com.hk"),
    ("MTRB", "MTR Bus", "https://www.mtr.com.hk"),
    ("GMB", "Green Minibus", "https://td.gov.hk"),
    ("NLB", "New Lantao Bus", "https://www.nlb.com.hk"),
    ("FERRY", "Ferry Services", "https://td.gov.hk"),
    ("MTRR", "MTR Rail", "https://www.mtr.com.hk"),
    ("LR", "Light Rail", "https://www.mtr.com.hk"),
    ("AE", "Airport Express", "https://www.mtr.com.hk"),
    ("PT", "Peak Tram", "https://thepeak.com.hk"),
    ("TRAM", "Tramways", "https://www.hktramways.com"),
]
#: The region's box: south, west, north, east.
BOX = (22.15, 113.83, 22.56, 114.42)
TIMEZONE, LANGUAGE = "Asia/Hong_Kong", "en"
#: Route colours by agency; text is white.
COLORS = {"KMB": "EE171F", "CTB": "0053B9", "NLB": "8AB666", "MTRB": "AE2A42", "GMB": "34C759", "MTRR": "003DA5", "LR": "FF8800", "FERRY": "0099CC"}
TEXT_COLOR = "FFFFFF"
#: Light Rail: colours by route, and the routes that are circular.
LIGHT_RAIL_COLORS = {"505": "DA2128", "507": "00A54F", "610": "541912", "614": "15C0F2", "614P": "F6A4AA", "615": "FFDC01", "615P": "016584", "705": "7BC351", "706": "B279B4", "751": "F58220", "761P": "6E2C91"}
LIGHT_RAIL_DEFAULT_COLOR = "FF8800"
LIGHT_RAIL_CIRCULAR = ["705", "706"]
#: Separators of Chinese route names, in the order in which they are looked for.
CN_SEPARATORS = ["至", "往", "到", "->", "－", "-", " — ", "—", " – "]
#: Rail lines by code, and the names under which their headways are published, in the order in which they are tried.
LINES = [("EAL", "East Rail"), ("TML", "Tuen Ma"), ("TWL", "Tsuen Wan"), ("KTL", "Kwun Tong"), ("ISL", "Island"), ("TKL", "Tseung Kwan O"), ("SIL", "South Island"), ("AEL", "Airport Express"), ("TCL", "Tung Chung"), ("DRL", "Disneyland Resort")]
#: Slices of a rail day: from, to, headway, and which published headway goes before it.
SLICES = [(19800, 25200, 360, "none"), (25200, 36000, 180, "peak"), (36000, 61200, 300, "mid"), (61200, 72000, 180, "peak"), (72000, 82800, 360, "mid"), (82800, 90000, 600, "none")]
