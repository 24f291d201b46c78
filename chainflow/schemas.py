"""Entity schemas (Spark DDL).  Amounts are digit strings, times Unix seconds."""

from __future__ import annotations

from pyspark.sql.types import StructType

ERC20 = ("struct<transactionHash:string,type:string,from:string,to:string,value:string,"
         "blockTimestamp:bigint,logIndex:int,erc20Token:struct<address:string,name:string,"
         "symbol:string,decimals:int,valueWithDecimals:string>>")
ERC721 = ("struct<transactionHash:string,type:string,from:string,to:string,tokenId:string,"
          "blockTimestamp:bigint,logIndex:int,erc721Token:struct<address:string,name:string,"
          "symbol:string>>")
ERC1155 = ("struct<transactionHash:string,type:string,from:string,to:string,tokenId:string,"
           "value:string,blockTimestamp:bigint,logIndex:int,erc1155Token:struct<address:string,"
           "name:string,symbol:string>>")
INTERNAL = ("struct<from:string,to:string,internalTxType:string,value:string,gasUsed:string,"
            "gasLimit:string,transactionHash:string>")
LOG = ("struct<address:string,topic0:string,topic1:string,topic2:string,topic3:string,"
       "data:string,transactionIndex:int,logIndex:int,removed:boolean>")

TRANSACTION_FIELDS = (
    "blockHash:string,blockNumber:string,from:string,gas:string,gasPrice:string,"
    "maxFeePerGas:string,maxPriorityFeePerGas:string,txHash:string,txStatus:string,"
    "input:string,nonce:string,to:string,transactionIndex:int,value:string,type:int,"
    "chainId:string,receiptCumulativeGasUsed:string,receiptGasUsed:string,"
    "receiptEffectiveGasPrice:string,receiptRoot:string,blockTimestamp:bigint"
)
TRANSACTION = (
    f"struct<{TRANSACTION_FIELDS},erc20Transfers:array<{ERC20}>,erc721Transfers:array<{ERC721}>,"
    f"erc1155Transfers:array<{ERC1155}>,internalTransactions:array<{INTERNAL}>,logs:array<{LOG}>>"
)

BLOCK = ("struct<chainId:string,blockNumber:string,blockTimestamp:bigint,blockHash:string,"
         "txCount:int,baseFee:string,gasUsed:string,gasLimit:string,gasCost:string,"
         "parentHash:string,feesSpent:string,cumulativeTransactions:string>")

WEBHOOK_ENVELOPE = (f"struct<webhookId:string,eventType:string,messageId:string,"
                    f"event:struct<transaction:{TRANSACTION},logs:array<{LOG}>>>")

NEWHEADS_FRAME = ("struct<jsonrpc:string,id:int,method:string,result:string,"
                  "params:struct<subscription:string,result:struct<hash:string,"
                  "parentHash:string,number:string>>>")

NETWORK_TOKEN = "struct<name:string,symbol:string,decimals:int,logoUri:string,description:string>"
CHAIN = ("struct<chainId:string,status:string,chainName:string,description:string,"
         "platformChainId:string,subnetId:string,vmId:string,vmName:string,"
         "explorerUrl:string,rpcUrl:string,wsUrl:string,isTestnet:boolean,private:boolean,"
         f"chainLogoUri:string,enabledFeatures:array<string>,networkToken:{NETWORK_TOKEN}>")
BLOCKCHAIN = "struct<blockchainId:string,vmId:string,subnetId:string>"
SUBNET = f"struct<subnetId:string,blockchains:array<{BLOCKCHAIN}>>"
VALIDATOR = "struct<nodeId:string,startTime:bigint,endTime:bigint,stakeAmount:string,uptime:bigint>"
DELEGATOR = ("struct<delegator:string,nodeId:string,stakeAmount:string,startTime:bigint,"
             "endTime:bigint,rewardAddress:string>")
BRIDGE_TX = ("struct<id:string,sourceChain:string,destChain:string,asset:string,amount:string,"
             "sender:string,receiver:string,status:string>")
TOKEN = ("struct<address:string,name:string,symbol:string,decimals:int,logoUri:string,"
         "price:struct<value:double,currencyCode:string>>")
METRIC_POINT = "struct<timestamp:bigint,value:decimal(38,9)>"


def page(entity: str, array_field: str) -> str:
    """A landed API page: ``{<array_field>: [...], nextPageToken}``."""
    return f"struct<{array_field}:array<{entity}>,nextPageToken:string>"


def ddl(struct_type: str) -> StructType:
    return StructType.fromDDL(struct_type)
