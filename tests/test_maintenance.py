from shoprank.functions.columns import username_hash
from shoprank.operators import maintenance, serving
from shoprank import schemas as S

R = "userId int, productId int, score double, timestamp bigint"
EV = "userId int, productId int, score double, timestamp bigint, seq bigint"


def test_ingest_ratings(spark):
    old = spark.createDataFrame([(1, 10, 2.0, 100), (1, 11, 3.0, 200)], R)
    new = spark.createDataFrame([(1, 10, 5.0, 999, 1), (2, 12, 1.0, 1451606400123, 2),
                                 (2, 12, 4.0, 1451606401000, 3)], EV)
    got = sorted(map(tuple, maintenance.ingest_ratings(old, new).collect()))
    assert got == [(1, 10, 5.0, 100), (1, 11, 3.0, 200), (2, 12, 4.0, 1451606400)]
    one = maintenance.ingest_ratings(old, new.where("seq <= 2"))
    two = sorted(map(tuple, maintenance.ingest_ratings(one, new.where("seq > 2")).collect()))
    assert two == got  # one batch gives what its events give one after another


def test_register_users(spark):
    existing = spark.createDataFrame([(5, "ann", "pw", True, 0, [])], S.USER_SCHEMA)
    incoming = spark.createDataFrame([("ann", "x", 1), ("bob", "b1", 2), ("bob", "b2", 3), ("", "e", 4)],
                                     "username string, password string, seq long")
    got = {r.username: r for r in maintenance.register_users(existing, incoming, now_ms=7).collect()}
    assert set(got) == {"bob", ""}
    assert got["bob"].password == "b1" and got["bob"].first is True and got["bob"].timestamp == 7
    assert got[""].userId == 0


def test_repeated_changes_do_not_multiply_users(spark):
    users = spark.createDataFrame([(1, "a", "p", True, 0, [])], S.USER_SCHEMA)
    changes = spark.createDataFrame([(1, True, ["x"], 1), (1, False, ["y"], 2)],
                                    "userId int, first boolean, prefGenres array<string>, seq long")
    got = [(r.userId, r.first, r.prefGenres) for r in maintenance.update_preferences(users, changes).collect()]
    assert got == [(1, False, ["y"])]


def test_update_preferences(spark):
    users = spark.createDataFrame([(1, "a", "p", True, 0, []), (2, "b", "p", True, 0, [])], S.USER_SCHEMA)
    changes = spark.createDataFrame([(2, False, ["x"])], "userId int, first boolean, prefGenres array<string>")
    got = {r.userId: (r.first, r.prefGenres) for r in maintenance.update_preferences(users, changes).collect()}
    assert got == {1: (True, []), 2: (False, ["x"])}


def test_hydrate_unknown_duplicate_and_missing_average(spark):
    products = spark.createDataFrame([(1, "a", "", "", ""), (2, "b", "", "", "")], S.PRODUCT_SCHEMA)
    averages = spark.createDataFrame([(1, 4.5)], "productId int, avg double")
    recs = spark.createDataFrame([(1, 2), (1, 1), (2, 3), (99, 4)], "productId int, rank int")
    got = sorted((r.productId, r.rank, r.score) for r in serving.hydrate(recs, products, averages).collect())
    assert got == [(1, 1, 4.5), (2, 3, 0.0)]


def test_resolve_users(spark):
    users = spark.createDataFrame([(3, "ann"), (4, "bob")], "userId int, username string")
    req = spark.createDataFrame([("ann",), ("zed",), ("ann",)], "username string")
    assert sorted(map(tuple, serving.resolve_users(req, users).collect())) == [("ann", 3)]


def test_search_is_unanchored_regex(spark):
    products = spark.createDataFrame([(1, "Red Car", "", "", ""), (2, "blue", "", "", "")], S.PRODUCT_SCHEMA)
    averages = spark.createDataFrame([], "productId int, avg double")
    got = [r.productId for r in serving.search_products(products, averages, "ed C").collect()]
    assert got == [1]


def test_names_that_share_an_id_are_reported(spark):
    empty = spark.createDataFrame([], S.USER_SCHEMA)
    incoming = spark.createDataFrame([("Aa", "", 1), ("BB", "", 2), ("C", "", 3), ("Aa", "", 4)], "username string, password string, seq int")
    users = maintenance.register_users(empty, incoming, now_ms=1)
    assert users.count() == 3
    assert [(r.userId, r.usernames) for r in maintenance.id_collisions(users).collect()] == [(2112, ["Aa", "BB"])]
    assert [(r.userId, r.usernames) for r in maintenance.id_collisions(users.unionByName(users)).collect()] == [(2112, ["Aa", "BB"])]
