"""Fixed values.

Names, formats, thresholds and tables that results depend on. They are stated here
as plain text so that every operator takes its defaults from one place; all of them
can be overridden through operator parameters.
"""

# --- fixed values: topic grammar ------------------------------------------------
TOPIC_ROOT = "i483"
SENSOR_BRANCH = "sensors"
ACTUATOR_BRANCH = "actuators"
TOPIC_SEPARATOR = "-"
ALL_DEVICES_PATTERN = "i483-sensors-s[0-9]+-[A-Z0-9]+-[a-zA-Z0-9_]+"
OWN_DEVICE_PATTERN = "i483-sensors-{owner}-[A-Z0-9]+-[a-zA-Z0-9_]+"
RESULT_PREFIX = "i483-sensors-{owner}-analytics"
OCCUPANCY_TOPIC = "i483-sensors-{owner}-analytics-occupancy_detection"
ROLLING_MEAN_TOPIC = "i483-sensors-{device}-{sensor}_avg-{metric}"
THRESHOLD_TOPIC = "i483-actuators-{device}-co2_threshold_crossed"
THRESHOLD_TOPIC_SUFFIX = "/co2_threshold_crossed"
MQTT_BASE = "i483/sensors/{device}/"
DEAD_TOPIC = "i483-dead-messages"

DEVICE_METRICS = (
    "SCD41/co2",
    "SCD41/temperature",
    "SCD41/humidity",
    "BH1750/illumination",
    "RPR0521RS/ambient_light",
    "RPR0521RS/proximity",
    "RPR0521RS/illumination",
    "RPR0521RS/infrared_illumination",
    "DPS310/temperature",
    "DPS310/air_pressure",
    "DPS310/altitude",
)

# --- fixed values: windows, thresholds, timeouts ---------------------------------
STATS_SIZE = "5 minutes"
STATS_SLIDE = "30 seconds"
EXPECTED_INTERVAL = "15 seconds"
TREND_SIZE = "5 minutes"
TREND_SLIDE = "1 minute"
TREND_MIN_POINTS = 3
JUMP_THRESHOLD = 100.0
OCCUPANCY_TIMEOUT = "1 hour"
ROLLING_WIDTH = "5 minutes"
ROLLING_PERIOD = "30 seconds"
CO2_THRESHOLD = 700
OUT_OF_ORDERNESS = "10 seconds"
SOURCE_IDLENESS = "60 seconds"
CHECKPOINT_PERIOD = "30 seconds"
SMALLEST_POSITIVE_DOUBLE = 4.9e-324

# --- fixed values: bridge producer defaults --------------------------------------
PRODUCER_DEFAULTS = {
    "linger.ms": "10",
    "delivery.timeout.ms": "1000",
    "request.timeout.ms": "500",
    "partitioner.ignore.keys": "true",
    "metadata.max.age.ms": "5000",
}

# --- fixed values: sensor data sheets --------------------------------------------
BH1750_COUNTS_PER_LUX = 1.2
BH1750_ACCURACY_RANGE = (0.96, 1.44)

RPR_GAINS = (1, 2, 64, 128)
RPR_MEASURE_MS = (0, 0, 0, 0, 0, 100, 100, 100, 100, 100, 400, 400, 50, 0, 0, 0)
RPR_SATURATING_MS = 50
RPR_NEAR_COUNT = 1000
# upper bound of d1/d0, weight of d0, weight of d1 (subtracted)
RPR_LUX_SEGMENTS = (
    (0.595, 1.682, 1.877),
    (1.015, 0.644, 0.132),
    (1.352, 0.756, 0.243),
    (3.053, 0.766, 0.25),
)

# oversampling rate -> scale factor
DPS310_SCALE = {
    1: 524288.0,
    2: 1572864.0,
    4: 3670016.0,
    8: 7864320.0,
    16: 253952.0,
    32: 516096.0,
    64: 1040384.0,
    128: 2088960.0,
}
SEA_LEVEL_HPA = 1013.25
BAROMETRIC_METRES = 44330.0
BAROMETRIC_EXPONENT = 0.190284
BAROMETRIC_INVERSE_EXPONENT = 5.255301895

SCD41_DIVISOR = 65536.0
SCD41_READY_MASK = 0x07FF
CRC8_POLYNOMIAL = 0x31
CRC8_INITIAL = 0xFF

LOCAL_ZONE = "Asia/Tokyo"
