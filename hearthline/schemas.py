"""Schemas of the target tables and of the messages between jobs."""

RAW_EVENT = "struct<date: string, description: string, price: double, source: string, mlsNumber: string>"
EVENT = "struct<event_ts: timestamp, event_type: string, price: decimal(18,2), source: string, source_id: string, description: string>"
RAW_RECORD = (
    "url string, data_source_name string, data_source_id string, scraped_at string, address string, area string, property_type string, lot_area string, "
    f"bedrooms double, bathrooms double, year_built int, status string, price double, ready_to_build boolean, property_id string, history array<{RAW_EVENT}>"
)
REJECTS = "record_key string, stage string, error_code string, message string, payload string"
PROPERTIES = (
    "property_id string, address struct<street: string, unit: string, city: string, state: string, zip_code: string, address_hash: string>, address_hash string, "
    "area struct<value: decimal(18,4), unit: string>, lot_area struct<value: decimal(18,4), unit: string>, property_type string, bedrooms decimal(5,2), bathrooms decimal(5,2), "
    "year_built int, price decimal(18,2), last_updated timestamp, data_sources array<struct<source_id: string, source_url: string, source_name: string>>, city string, zip_code string, state string, status string"
)
PROPERTY_EVENTS = "event_id string, property_id string, event_ts timestamp, event_type string, price decimal(18,2), source string, source_id string, description string"
# Keys of raw records as crawlers write them, and the columns they become.
RAW_KEYS = {
    "url": "url", "redfinId": "data_source_id", "scrapedAt": "scraped_at", "address": "address", "area": "area", "propertyType": "property_type", "lotArea": "lot_area",
    "numberOfBedroom": "bedrooms", "numberOfBathroom": "bathrooms", "yearBuilt": "year_built", "status": "status", "price": "price", "readyToBuildTag": "ready_to_build", "propertyId": "property_id", "history": "history",
}
# The source that records must name, and the required fields of both messages.
SOURCE_NAME = "Redfin"
URL_MESSAGE = ["property_url", "scraped_at_utc", "data_source", "from_page_url"]
RAW_MESSAGE = ["data", "url", "redfinId", "zipCode", "scrapedAt", "spiderName"]
