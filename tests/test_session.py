from fleetpulse.session import METHOD_BYTES, METHOD_SETTING, compiled


def test_wide_rows_are_compiled_unless_the_session_says_otherwise(spark):
    other = spark.newSession()
    other.conf.unset(METHOD_SETTING)
    assert compiled(other).conf.get(METHOD_SETTING) == METHOD_BYTES
    other.conf.set(METHOD_SETTING, "65535")
    assert compiled(other).conf.get(METHOD_SETTING) == "65535"
