"""The command line on small input folders (star v1, lake chain, SSB layout study)."""

import gzip
import json
import os

from wharf.__main__ import main


def write_json(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_star_v1_cli(spark, tmp, capsys):
    write_json(tmp + "/log", [
        {"artist": "A1", "firstName": "Ann", "lastName": "Lee", "gender": "F", "level": "paid",
         "page": "NextSong", "sessionId": 1, "song": "T", "ts": 1541121934796, "userId": 7,
         "location": "X", "userAgent": "ua", "length": 200.0, "itemInSession": 0},
        {"artist": "A1", "firstName": "Ann", "lastName": "Lee", "gender": "F", "level": "free",
         "page": "Home", "sessionId": 1, "song": None, "ts": 1541121935796, "userId": 7},
    ])
    write_json(tmp + "/songs", [
        {"num_songs": 1, "artist_id": "AR1", "artist_name": "A1", "song_id": "S1", "title": "T",
         "duration": 200.0, "year": 2000, "artist_location": "L", "artist_latitude": 1.0,
         "artist_longitude": 2.0},
    ])
    assert main(["star-v1", "--log-data", tmp + "/log", "--song-data", tmp + "/songs",
                 "--out", tmp + "/out"]) == 0
    out = capsys.readouterr().out
    assert "PASSED: users: rows (value: 1)" in out
    assert "top_songs_by_gender: 1 rows in " in out and "Ann Lee" in out
    # Results are written whole; the console shows a marked preview.
    assert spark.read.parquet(tmp + "/out/results/plays_by_location_level").count() == 1
    assert spark.read.parquet(tmp + "/out/dq_report").count() == 17


def test_lake_chain_cli(spark, tmp, capsys):
    write_json(tmp + "/c", [{"customerName": "A", "email": "a@x", "serialNumber": "s1",
                             "shareWithResearchAsOfDate": 5}])
    write_json(tmp + "/a", [{"user": "a@x", "timestamp": 100, "x": 1.0, "y": 0.0, "z": 0.0}])
    write_json(tmp + "/s", [{"sensorReadingTime": 100, "serialNumber": "s1",
                             "distanceFromObject": 3}])
    assert main(["lake-chain", "--customer", tmp + "/c", "--accelerometer", tmp + "/a",
                 "--step-trainer", tmp + "/s", "--out", tmp + "/lake"]) == 0
    assert "machine_learning_curated: machine_learning_curated (1 rows)" in capsys.readouterr().out


def test_ssb_cli(spark, tmp, capsys):
    def tbl(name, lines):
        os.makedirs(f"{tmp}/ssb/{name}")
        with gzip.open(f"{tmp}/ssb/{name}/{name}.tbl.gz", "wt") as f:
            f.write("".join(line + "|\n" for line in lines))
    tbl("lineorder", ["1|1|1|1|1|19971201|1-URGENT|0|10|1000|5000|2|900|600|3|19971205|AIR",
                      "2|1|1|1|1|19970301|1-URGENT|0|30|2000|5000|2|1800|600|3|19970305|AIR"])
    tbl("part", ["1|p|MFGR#1|MFGR#12|MFGR#121|red|t|5|box"])
    tbl("supplier", ["1|s|addr|UNITED KI1|UNITED KINGDOM|AMERICA|phone"])
    tbl("customer", ["1|c|addr|UNITED KI5|UNITED KINGDOM|EUROPE|phone|BUILDING"])
    tbl("dwdate", ["19971201|Dec 1, 1997|Monday|December|1997|199712|Dec1997|2|1|335|12|49|Winter|0|0|0|1",
                   "19970301|Mar 1, 1997|Saturday|March|1997|199703|Mar1997|7|1|60|3|9|Spring|0|0|0|0"])
    assert main(["ssb", "--data", tmp + "/ssb", "--out", tmp + "/ssb_out", "--buckets", "4"]) == 0
    out = capsys.readouterr().out
    for q in ("oneDim", "twoDim", "drill", "oneDimSameDist"):
        assert q in out


def test_load_study_cli(spark, tmp, capsys):
    rows = [f"{i};1;2;1;A;3;4;{i * 10 if i % 3 else ''};{i}.50" for i in range(40)]
    os.makedirs(tmp + "/split")
    for p in range(4):
        with gzip.open(f"{tmp}/split/tickets.part{p}.csv.gz", "wt") as f:
            f.write("\n".join(rows[p::4]) + "\n")
    with gzip.open(f"{tmp}/tickets_full.csv.gz", "wt") as f:
        f.write("\n".join(rows) + "\n")
    assert main(["load-study", "--split", tmp + "/split", "--single",
                 tmp + "/tickets_full.csv.gz"]) == 0
    out = capsys.readouterr().out
    assert "split" in out and "single" in out


def test_serving_cli(spark, tmp, capsys):
    header = ("artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,"
              "page,registration,sessionId,song,status,ts,userId")
    lines = [
        header,
        'Band,Logged In,Ann,F,4,Lee,200.5,paid,"San Jose, CA",PUT,NextSong,1.54E+12,338,Old,200,1.54111E+12,10',
        'Band,Logged In,Ann,F,4,Lee,201.5,paid,"San Jose, CA",PUT,NextSong,1.54E+12,338,New,200,1.54112E+12,10',
        ',Logged In,Ann,F,5,Lee,,paid,"San Jose, CA",GET,Home,1.54E+12,338,,200,1.54113E+12,10',
        'Crew,Logged In,Bo,M,0,Ray,100.0,free,"Reno, NV",PUT,NextSong,1.54E+12,182,All Hands Against His Own,200,1.54114E+12,10',
    ]
    os.makedirs(tmp + "/event_data")
    with open(tmp + "/event_data/2018-11-01-events.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    assert main(["serving", "--event-data", tmp + "/event_data", "--out", tmp + "/srv",
                 "--buckets", "4"]) == 0
    out = capsys.readouterr().out
    assert "'lines': 4" in out                       # header + 3 rows with an artist
    assert "New" in out and "| Old" not in out       # last write wins on (338, 4)
    assert "Bo" in out and "Ray" in out               # user_by_song lookup
