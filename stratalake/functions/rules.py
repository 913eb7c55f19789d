"""Word rules and tables that texts are classified by."""

from __future__ import annotations

#: Topics in the order in which they are tried, each with the words that give it away.
TOPICS = [
    ("geophysics", r"gravity|aeromagnetic|\bmagnetic\b|seismic|geophysic"),
    ("hazards", r"hazard|landslide|liquefaction|\bflood|earthquake|debris.?flow|rockfall|surface.fault|radon|expansive soil"),
    ("mineral-energy", r"mineral resource|mineral potential|\bmining\b|\bore\b|uranium|\bcoal\b|oil and gas|gas field|petroleum|geothermal|potash|tar sand|\blithium\b|critical mineral|energy"),
    ("paleontology", r"paleontolog|\bfossil|dinosaur|trilobite|trackway|\bbones?\b|ammonite|\bmammoth|ice.age animal"),
    ("glacial", r"glacier|glacial|ice age|pleistocene|lake bonneville|moraine"),
    ("hydro", r"hydrogeolog|ground.?water|aquifer|water resource|hydrolog|wetland|spring\b|\bbrine\b|great salt lake"),
    ("caves", r"\bcave|karst|sinkhole|speleo|\bcavern"),
    ("education", r"teacher|classroom|\beducation|glad you asked|curriculum|\bstudent|geologic time|rock cycle"),
    ("geosites", r"state park|national (park|monument)|geosite|scenic|hoodoo|geologic wonder|rock.?hound|geotour"),
    ("history", r"\bhistory\b|historic|pioneer|heritage|mining camp|ghost town"),
    ("surficial", r"surficial"),
    ("geologic", r"geologic|geology|bedrock|stratigraph|formation\b|quadrangle|\bmapping\b|geologic map"),
]
#: Media types by the ending of a file's name.
MEDIA = {
    "pdf": "application/pdf",
    "zip": "application/zip",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xls": "application/vnd.ms-excel",
    "csv": "text/csv",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "txt": "text/plain",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "html": "text/html",
    "htm": "text/html",
    "kmz": "application/vnd.google-earth.kmz",
    "kml": "application/vnd.google-earth.kml+xml",
    "parquet": "application/vnd.apache.parquet",
    "json": "application/json",
}
