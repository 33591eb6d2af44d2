"""Values every run must agree on."""

# Event topics and addresses defined by the token standards.
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
APPROVAL_TOPIC = "0x8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925"
ZERO_ADDRESS = "0x" + "0" * 40

# Defaults of paging, chunking and retrying.
PAGE_ROWS = 1000
CHUNK_BLOCKS = 20_000
RETRY_DIVISOR = 10
RETRY_MIN_BLOCKS = 1000

# API fields that hold numbers as hex or decimal text.
NUMERIC_FIELDS = (
    "blockNumber",
    "timeStamp",
    "logIndex",
    "transactionIndex",
    "gasPrice",
    "gasUsed",
    "nonce",
    "value",
    "gas",
    "cumulativeGasUsed",
    "confirmations",
)

# Chain name -> chain id.
CHAIN_IDS = {
    "ethereum": 1,
    "sepolia_testnet": 11155111,
    "holesky_testnet": 17000,
    "hoodi_testnet": 560048,
    "abstract": 2741,
    "abstract_sepolia_testnet": 11124,
    "ape_chain_curtis_testnet": 33111,
    "ape_chain": 33139,
    "arbitrum_nova": 42170,
    "arbitrum_one": 42161,
    "arbitrum_sepolia_testnet": 421614,
    "avalanche_c-_chain": 43114,
    "avalanche_fuji_testnet": 43113,
    "base": 8453,
    "base_sepolia_testnet": 84532,
    "berachain": 80094,
    "berachain_bepolia_testnet": 80069,
    "bit_torrent_chain": 199,
    "bit_torrent_chain_testnet": 1028,
    "blast": 81457,
    "blast_sepolia_testnet": 168587773,
    "bnb_smart_chain": 56,
    "bnb_smart_chain_testnet": 97,
    "celo_alfajores_testnet": 44787,
    "celo": 42220,
    "cronos": 25,
    "fraxtal": 252,
    "fraxtal_testnet": 2522,
    "gnosis": 100,
    "hyper_evm": 999,
    "linea": 59144,
    "linea_sepolia_testnet": 59141,
    "mantle": 5000,
    "mantle_sepolia_testnet": 5003,
    "memecore": 4352,
    "memecore_testnet": 43521,
    "moonbase_alpha_testnet": 1287,
    "monad_testnet": 10143,
    "moonbeam": 1284,
    "moonriver": 1285,
    "op": 10,
    "op_sepolia_testnet": 11155420,
    "polygon_amoy_testnet": 80002,
    "polygon": 137,
    "katana": 747474,
    "sei": 1329,
    "sei_testnet": 1328,
    "scroll": 534352,
    "scroll_sepolia_testnet": 534351,
    "sonic_blaze_testnet": 57054,
    "sonic": 146,
    "sophon": 50104,
    "sophon_sepolia_testnet": 531050104,
    "swellchain": 1923,
    "swellchain_testnet": 1924,
    "taiko_hekla_l2_testnet": 167009,
    "taiko": 167000,
    "unichain": 130,
    "unichain_sepolia_testnet": 1301,
    "wemix3.0": 1111,
    "wemix3.0_testnet": 1112,
    "world": 480,
    "world_sepolia_testnet": 4801,
    "xai": 660279,
    "xai_sepolia_testnet": 37714555429,
    "xdc_apothem_testnet": 51,
    "xdc": 50,
    "zk_sync": 324,
    "zk_sync_sepolia_testnet": 300,
    "op_bnb": 204,
    "op_bnb_testnet": 5611,
}
